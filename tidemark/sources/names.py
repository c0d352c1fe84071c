"""Names in the session's catalog for what stored tables hold.

A name is a view on the folders of one version, so any session of the catalog reads the
table by it, also one that knows nothing of this library. It lasts as long as the catalog does,
with a metastore beyond the application. The view carries the table's path, by which later
versions find the names that are theirs to turn.
"""

from __future__ import annotations

from tidemark import storage
from tidemark.sources.tables import StoredTable

PATH_PROPERTY = "tidemark.path"


def name_table(table: StoredTable, name: str) -> None:
    """Let ``name`` stand for the newest version; a view of that name is replaced."""
    folders, path = table.folders(), _path(table)
    if folders:
        columns = ", ".join(_ticked(field.name) for field in table.schema)
        query = f"SELECT {columns} FROM parquet.{_ticked(_pattern(path, [folder[len(table.path) + 1 :] for folder in folders]))}"
    else:
        columns = ", ".join(
            f"CAST(NULL AS {field.dataType.simpleString()}) AS {_ticked(field.name)}"
            for field in table.schema
        )
        query = f"SELECT {columns} WHERE false"
    table.spark.sql(
        f"CREATE OR REPLACE VIEW {_ticked(name)} "
        f"TBLPROPERTIES ('{PATH_PROPERTY}' = {_literal(path)}) AS {query}"
    )


def rename_table(table: StoredTable, name: str) -> None:
    """Turn ``name`` to the newest version if it is a name of this table; else leave it."""
    if named_path(table, name) == _path(table):
        name_table(table, name)


def named_path(table: StoredTable, name: str) -> str | None:
    """Path of the stored table that ``name`` stands for."""
    if not table.spark.catalog.tableExists(_ticked(name)):
        return None
    found = table.spark.sql(f"SHOW TBLPROPERTIES {_ticked(name)}").collect()
    return next((row["value"] for row in found if row["key"] == PATH_PROPERTY), None)


def _path(table: StoredTable) -> str:
    return storage.qualified(table.spark, table.path)


def _pattern(path: str, folders: list[str]) -> str:
    """One path that stands for all folders."""
    return f"{path}/{{{','.join(folders)}}}"


def _ticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
