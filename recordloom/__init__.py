"""recordloom: Spark-native shredding and change-merging of nested business records."""

from recordloom.spec import Child, Entity, Policy, TableSpec

__all__ = ["Child", "Entity", "Policy", "TableSpec"]
__version__ = "0.1.0"
