"""Declared tables of each domain and the DataFrame plans that fill them."""
