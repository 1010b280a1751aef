"""Project management: portal and project records with custom fields, tags, people and time logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import coalesce_keys, flatten_record, stamp
from recordloom.operators.keys import require_key
from recordloom.operators.shred import (
    carry_context,
    melt_custom_fields,
    shape_union,
    tag_associations,
    tagged_union,
)
from recordloom.spec import Policy, TableSpec, parse_tables, struct_field

# Tables and what follows ``portal_id`` (or ``portal_id, project_id``) in their keys.
PORTAL_TABLES = """
portals:
modules: module_api_name
fields: module_api_name, field_api_name
project_layouts: layout_id
task_layouts: layout_id
timesheet_layouts: project_id
project_custom_fields_meta: field_api_name
task_custom_fields_meta: field_api_name
timesheet_custom_fields_meta: field_api_name
project_custom_statuses: status_id
project_groups: group_id
tags: tag_id
users: user_id
clients: client_id
client_users: client_user_id
leaves: leave_id
time_logs: log_id
timesheet_custom_fields: log_id, field_api_name
profiles: profile_id
roles: role_id
teams: team_id
phases: phase_id
tag_associations: entity_type, entity_id, tag_id
"""
PROJECT_TABLES = """
projects:
bug_custom_fields_meta: field_api_name
bug_default_fields: field_name
bug_renamed_fields: field_name
project_users: user_id
project_clients: client_id
project_custom_fields: field_api_name
project_teams: team_id
project_comments: comment_id
project_activities: activity_id
project_statuses: status_id
milestones: milestone_id
tasklists: tasklist_id
tasks: task_id
task_custom_fields: task_id, field_api_name
task_custom_views: view_id
task_comments: task_id, comment_id
task_followers: task_id, user_id
task_owners: task_id, user_id
task_dependencies: task_id, depends_on_task_id, direction
task_activities: task_id, activity_id
task_attachments: task_id, attachment_id
task_status_history: task_id, history_id
subtasks: task_id, subtask_id
bugs: bug_id
bug_custom_fields: bug_id, field_api_name
bug_comments: bug_id, comment_id
bug_attachments: bug_id, attachment_id
bug_resolutions: bug_id
bug_timers: bug_id
bug_followers: bug_id, user_id
bug_activities: bug_id, activity_id
bug_task_associations: bug_id, task_id
bug_custom_views: view_id
events: event_id
event_comments: event_id, comment_id
forums: forum_id
forum_categories: category_id
forum_comments: forum_id, comment_id
forum_followers: forum_id, user_id
forum_attachments: forum_id, attachment_id
folders: folder_id
documents: document_id
document_versions: document_id, version_id
"""
MODIFIED = ("users", "clients", "projects", "milestones", "tasklists", "tasks", "bugs", "time_logs", "task_comments", "task_status_history")
APPEND_ONLY = ("project_activities", "project_statuses")
# Field names that hold the id besides ``id``, ``<table id>`` and ``id_string``.
PERSON_IDS = ("zpuid", "id", "user_id", "id_string")
SPECIAL_IDS = {
    "task_followers": PERSON_IDS, "task_owners": PERSON_IDS, "bug_followers": PERSON_IDS, "forum_followers": PERSON_IDS,
    "users": ("id", "user_id", "zpuid"), "project_users": ("id", "user_id", "zpuid"), "client_users": ("id", "client_user_id", "zpuid"),
    "task_attachments": ("id", "attachment_id", "file_id", "id_string"),
    "bug_attachments": ("id", "attachment_id", "file_id", "id_string"),
    "forum_attachments": ("id", "attachment_id", "file_id", "id_string"),
    "task_dependencies": ("id", "task_id", "id_string", "dependent_task_id"),
    "document_versions": ("version_id", "id", "id_string"),
    "bug_custom_views": ("id", "view_id", "cview_id", "id_string"),
    "modules": ("api_name", "module_api_name", "name"),
    "fields": ("api_name", "field_api_name", "field_name"),
    "bug_default_fields": ("field_name", "fieldName", "name"), "bug_renamed_fields": ("field_name", "fieldName", "name"),
    **dict.fromkeys(
        ("project_custom_fields_meta", "bug_custom_fields_meta", "timesheet_custom_fields_meta", "task_custom_fields_meta"),
        ("column_name", "api_name", "field_api_name", "UDF", "udf", "id", "field_id"),
    ),
}
ENTITY_TYPES = {
    "projects": "project", "milestones": "milestone", "tasklists": "tasklist", "tasks": "task", "bugs": "bug",
    "forums": "forum", "project_statuses": "status",
}
CUSTOM_FIELD_TABLES = {
    "projects": "project_custom_fields", "tasks": "task_custom_fields", "bugs": "bug_custom_fields",
    "time_logs": "timesheet_custom_fields",
}
FOLLOWER_PLACES = (
    "followers", "followers.USERS", "followers.users", "followers.user_list", "followers.list", "followers_list", "follower_list",
)
OWNER_PLACES = ("details.owners", "assignees", "owners")
MODIFIED_FIELDS = ("last_modified_time_long", "modified_time_long", "last_modified_long")


def _specs() -> dict[str, TableSpec]:
    out = {}
    for prefix, text in ((("portal_id",), PORTAL_TABLES), (("portal_id", "project_id"), PROJECT_TABLES)):
        for name, spec in parse_tables(text).items():
            own = () if spec.pk == ("id",) else spec.pk
            policy, cursor = Policy.FULL, ()
            if name in MODIFIED:
                policy, cursor = Policy.MODIFIED, MODIFIED_FIELDS
            elif name in APPEND_ONLY:
                policy, cursor = Policy.MAX_ID, (own[-1],)
            pk = (*prefix, *[c for c in own if c not in prefix])
            out[name] = TableSpec(name, pk, policy=policy, cursor=cursor)
    return out


SPECS: dict[str, TableSpec] = _specs()


def id_sources(table: str) -> tuple[str, ...]:
    own = _own_key(table)
    return SPECIAL_IDS.get(table, ("id", own, "id_string"))


def _own_key(table: str) -> str:
    pk = SPECS[table].pk
    return pk[-2] if table == "task_dependencies" else pk[-1]


def _sections(df: DataFrame) -> list[str]:
    """Array-of-object fields that other tables cover."""
    covered = {"tags", "customfields", "followers", "followers_list", "follower_list", "assignees", "owners", "dependency", "dependencies"}
    return [f.name for f in df.schema.fields if f.name in covered]


def rows(table: str, records: DataFrame, **keys) -> DataFrame:
    """Flat rows of one table: id from its alternative fields, outer keys as columns, custom fields and covered arrays apart."""
    own = _own_key(table)
    if own in keys:
        keyed = stamp(records, **keys)
    else:
        keyed = coalesce_keys(stamp(records, **keys), id_sources(table), own)
    kept = [c for c in SPECS[table].pk if c in keyed.columns]
    flat = flatten_record(keyed, "named", drop=_sections(records), keep=kept)
    return require_key(flat, kept)[0]


def people(table: str, parents: DataFrame, places: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Owners or followers of tasks, bugs or forums, wherever the record keeps the list."""
    listed = shape_union(parents, places, "_people")
    persons = listed.select(*carry, F.explode("_people").alias("p")).select(*carry, "p.*")
    keyed = coalesce_keys(persons, PERSON_IDS, "user_id")
    return require_key(flatten_record(keyed, "named", keep=[*carry, "user_id"]), ["user_id"])[0]


def dependencies(tasks: DataFrame, carry: Sequence[str] = ("portal_id", "project_id", "task_id")) -> DataFrame:
    """Successors and predecessors, or a bare list of unknown direction."""
    field = struct_field(tasks.schema, "dependency")
    if field is not None and isinstance(field.dataType, T.ArrayType):
        arrays = {"dependency": "unknown"}
    else:
        arrays = {"dependency.successor": "successor", "dependency.predecessor": "predecessor"}
    united = tagged_union(tasks, arrays, "direction", carry)
    keyed = coalesce_keys(united, ("id", "id_string", "dependent_task_id"), "depends_on_task_id")
    flat = flatten_record(keyed, "named", keep=[*carry, "direction", "depends_on_task_id"])
    return require_key(flat, ["depends_on_task_id"])[0]


def time_logs(buckets: DataFrame, portal_id: str) -> DataFrame:
    """``date, tasklogs[], buglogs[], generallogs[]`` (entries with an inner ``logs`` list) to one row per log."""
    arrays = {"tasklogs": "task", "buglogs": "bug", "generallogs": "general"}
    entries = tagged_union(buckets, arrays, "component_type", ["date"])
    logs = carry_context(entries, "logs", ["date", "component_type"], {"log_date": "date"})
    keyed = coalesce_keys(stamp(logs.drop("date"), portal_id=portal_id), ("id", "log_id"), "log_id")
    flat = flatten_record(keyed, "named", keep=["portal_id", "log_id", "component_type"])
    return require_key(flat, ["log_id"])[0]


def custom_fields(table: str, records: DataFrame, meta: DataFrame | None = None, meta_on: Sequence[str] = ()) -> DataFrame:
    """Long custom-field rows of a table's VARIANT records (``record`` beside the key columns)."""
    return melt_custom_fields(records, SPECS[table].pk, meta=meta, meta_on=meta_on)


def tags(table: str, records: DataFrame) -> DataFrame:
    """Tag associations of a table whose entities carry tags."""
    return tag_associations(records, ENTITY_TYPES[table], SPECS[table].pk[-1])
