"""Publication: nesting, flat and nested documents, point lookup."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collected(frame: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """by and ``name``: the values of each group as an array, in order."""
    item = F.struct(*order, value.alias("_value"))
    return frame.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_value"]).alias(name))


def with_children(parents: DataFrame, children: DataFrame, key: str, foreign: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``parents`` with their children nested in order, an empty array where there is none."""
    nested = collected(children, [foreign], order, value, name).withColumnRenamed(foreign, "_foreign")
    joined = parents.join(nested, parents[key] == F.col("_foreign"), "left").drop("_foreign")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))


def counted(parents: DataFrame, children: DataFrame, key: str, foreign: str, name: str) -> DataFrame:
    """``parents`` with the number of their children, zero where there is none."""
    n = children.groupBy(F.col(foreign).alias("_foreign")).agg(F.count(F.lit(1)).alias(name))
    return parents.join(n, parents[key] == F.col("_foreign"), "left").drop("_foreign").withColumn(name, F.coalesce(name, F.lit(0)))


def cite(text: Column, article: Column, item: Column | None = None) -> Column:
    """A citation as JSON; ``item`` is absent where it is empty, while other nulls of a document are kept."""
    parts = {"text": text, "article": article} | ({} if item is None else {"item": F.nullif(item, F.lit(""))})
    return F.to_json(F.struct(*(c.cast("string").alias(n) for n, c in parts.items())))


def json_object(fields: dict[str, Column], raw: dict[str, Column] | None = None) -> Column:
    """A JSON object with all ``fields``, nulls included, and ``raw`` members that are JSON already; null is null."""
    parts = []
    if fields:
        parts.append(F.regexp_replace(F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"}), r"^\{|\}$", ""))
    parts += [F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))) for name, value in (raw or {}).items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def csv_line(columns: list[Column]) -> Column:
    """A CSV line: quotes only where a comma, a quote or a line break asks for them, nulls empty."""
    def cell(c: Column) -> Column:
        s = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(s.rlike("[,\"\r\n]"), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)

    return F.concat_ws(",", *map(cell, columns))


def csv_documents(frame: DataFrame, by: list[str], path: Column, names: list[str], order: list[str]) -> DataFrame:
    """(path, kind, body): one CSV document for each group, header first, lines in order, each ended by a newline."""
    lines = frame.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, csv_line([F.col(n) for n in names]).alias("_line")))).alias("_lines"))
    body = F.concat(F.lit(",".join(names) + "\n"), F.array_join(F.transform("_lines", lambda x: F.concat(x["_line"], F.lit("\n"))), ""))
    return lines.select(path.alias("path"), F.lit("csv").alias("kind"), body.alias("body"))


def lookup(documents: DataFrame, path: str, base: str = "") -> DataFrame:
    """The document at ``path``; the base alone means its index. No row: not found."""
    wanted = path.removeprefix(base).lstrip("/") or "index.json"
    return documents.where(F.col("path") == wanted)


def answered(requests: DataFrame, documents: DataFrame, *, base: str = "") -> DataFrame:
    """``requests`` (method, path) with status, location and body, as a server of ``documents`` under ``base`` answers.

    Only GET and HEAD are allowed (405 otherwise); the base without its last slash leads to the index with it (302); a
    path without a document is not found (404). A HEAD, and all but 200, has no body.
    """
    root = "/" + base.strip("/") + ("/" if base.strip("/") else "")
    inside = F.col("path").startswith(root)
    wanted = F.when(inside, F.expr(f"substring(path, {len(root) + 1})"))
    rows = requests.withColumn("_wanted", F.when(wanted == "", "index.json").otherwise(wanted))
    joined = rows.join(documents.select(F.col("path").alias("_wanted"), F.col("body").alias("_body")), "_wanted", "left")
    bare = F.lit(root != "/") & (F.col("path") == root.rstrip("/"))
    status = F.when(~F.coalesce(F.col("method").isin("GET", "HEAD"), F.lit(False)), 405).when(bare, 302).when(F.col("_body").isNull(), 404).otherwise(200)
    full = joined.withColumn("status", status).withColumn("location", F.when(F.col("status") == 302, F.lit(root)))
    return full.withColumn("body", F.when((F.col("status") == 200) & (F.col("method") == "GET"), F.col("_body"))).drop("_wanted", "_body")


def published(documents: DataFrame, folder: str, *, wipe: bool = False) -> int:
    """Writes each document to a file below ``folder``, a path or URI that all tasks reach, and returns their number.

    ``wipe`` empties the folder first, so that no file of an earlier run stays. Files appear whole: each is written
    under another name and moved, so a task that runs again does no harm.
    """
    from pyarrow import fs

    uri = folder if "://" in folder else os.path.abspath(folder)
    system, root = fs.FileSystem.from_uri(uri)
    system.create_dir(root, recursive=True)
    if wipe:
        system.delete_dir_contents(root)

    def write(batches):
        system, root = fs.FileSystem.from_uri(uri)
        for batch in batches:
            paths, bodies = (batch.column(k).to_pylist() for k in (0, 1))
            for path, body in zip(paths, bodies):
                target = f"{root}/{path}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(part) as file:
                    file.write((body or "").encode())
                system.move(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([len(paths)], pa.int64())], names=["n"])

    return documents.select("path", "body").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
