"""Nested records, JSON, arrays and maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_path(payload: Column, *paths: str, dtype: str = "string") -> Column:
    """First non-null of several dotted paths, converted; what does not convert is NULL."""
    found = [F.get_json_object(payload, "$." + p.replace(":", ".")) for p in paths]
    return F.coalesce(*[c.try_cast(dtype) for c in found])


def typed_columns(df: DataFrame, payload: str, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """JSON payload as typed columns; the payload is parsed once."""
    schema = ", ".join(f"`{n}` {t}" for n, t in columns.items())
    return df.select(*keep, F.from_json(F.col(payload), schema).alias("_p")).select(*keep, "_p.*")


def flatten_array(df: DataFrame, array: str, fields: Mapping[str, Column], keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """One row per element of an array of structs (``e``), with chosen fields; outer keeps empty arrays."""
    explode = F.explode_outer if outer else F.explode
    return df.select(*keep, explode(array).alias("e")).select(*keep, *[c.alias(n) for n, c in fields.items()])


def field_of_every(array: Column, field: str) -> Column:
    return F.transform(array, lambda e: e.getField(field))


def json_field_of_every(payload: Column, array_path: str, field: str) -> Column:
    """One text field of every object of a JSON array inside a payload."""
    array = F.from_json(F.get_json_object(payload, f"$.{array_path}"), f"array<struct<`{field}`:string>>")
    return field_of_every(array, field)


def object_or_empty(payload: Column) -> Column:
    """JSON text of an object; anything else (absent, NULL, malformed, not an object) is '{}'."""
    parsed = F.try_parse_json(payload)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.when(is_object, F.to_json(parsed)).otherwise("{}")


def value_or_zero(*columns: str) -> list[Column]:
    """Nested numbers with 0 for a missing parent or field, named after the path."""
    return [F.coalesce(F.col(c), F.lit(0)).alias(c.replace(".", "_")) for c in columns]


def only_for(kind: Column, wanted: str, value: Column) -> Column:
    return F.when(kind == wanted, value)


def usage_rows(pages: DataFrame, pages_column: str = "data") -> DataFrame:
    """Landed pages of time buckets to one row per result, with the bucket's bounds."""
    buckets = pages.select(F.explode(pages_column).alias("b"))
    return buckets.select("b.starting_at", "b.ending_at", F.explode("b.results").alias("r")).select(
        "starting_at", "ending_at", "r.*"
    )


def one_or_many(payload: Column, element: str) -> Column:
    """A JSON list of objects, or a single object as a list of one; items that are not objects are left out."""
    many = F.from_json(payload, f"array<string>")
    single = F.when(F.ltrim(payload).startswith("{"), F.array(payload))
    items = F.when(F.ltrim(payload).startswith("["), many).otherwise(single)
    objects = F.filter(items, lambda x: F.ltrim(x).startswith("{"))
    return F.transform(objects, lambda x: F.from_json(x, element))


def property_history(df: DataFrame, object_id: str, history: str) -> DataFrame:
    """{property: [entries]} to one row per entry; objects without history give no row."""
    entries = df.select(F.col(object_id).alias("object_id"), F.explode(history).alias("property_name", "_entries"))
    return entries.select("object_id", "property_name", F.explode("_entries").alias("_e")).select(
        "object_id", "property_name", "_e.*"
    )


def association_list(owner: Column, results: Column, name: str) -> Column:
    """Distinct pairs (value, <name>_id) of an object's associations."""
    pair = lambda r: F.struct(owner.alias("value"), r.getField("id").alias(f"{name}_id"))
    return F.array_distinct(F.transform(results, pair))


def lift_properties(df: DataFrame, properties: str, id_column: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Named entries of a property map as columns; the object's id stays unless the properties hold one."""
    p = F.col(properties)
    own = [F.element_at(p, f).alias(f) for f in fields if f != "id"]
    return df.select(F.coalesce(F.element_at(p, "id"), F.col(id_column).cast("string")).alias("id"), *own, *keep)


def unnest_connection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace {nodes, totalCount} by its nodes and a ``<name>_totalCount`` column."""
    for c in columns:
        df = df.withColumn(f"{c}_totalCount", F.coalesce(F.col(f"{c}.totalCount"), F.lit(0)))
        df = df.withColumn(c, F.col(f"{c}.nodes"))
    return df


def unnest_inner_connection(array: Column, element: StructType, name: str) -> Column:
    """The same for a connection inside every element of an array."""
    def rebuild(e: Column) -> Column:
        parts = [e.getField(f).alias(f) for f in element.fieldNames() if f != name]
        inner = e.getField(name)
        return F.struct(
            *parts,
            inner.getField("nodes").alias(name),
            F.coalesce(inner.getField("totalCount"), F.lit(0)).alias(f"{name}_totalCount"),
        )

    return F.transform(array, rebuild)


def spread(df: DataFrame, struct: str, prefix: str = "") -> DataFrame:
    """Fields of a struct as columns, optionally prefixed, in place of the struct."""
    fields = df.schema[struct].dataType.fieldNames()
    rest = [c for c in df.columns if c != struct]
    return df.select(*rest, *[F.col(f"{struct}.{f}").alias(prefix + f) for f in fields])


def reacted_comments(df: DataFrame, comments: str, keep: Sequence[str]) -> DataFrame:
    """Comments with at least one dated reaction group, one row each."""
    has_date = lambda c: F.exists(c.getField("reactionGroups"), lambda g: g.getField("createdAt").isNotNull())
    return df.select(*keep, F.explode(F.filter(F.col(comments), has_date)).alias("comment"))


def attach_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, fields: Sequence[str], order: str, name: str = "children"
) -> DataFrame:
    """One row per parent with an ordered list of its children; no children gives an empty list.

    The list is one value of a row. Parents whose children may be without bound are better kept as rows, see ``child_rows``.
    """
    listed = (
        children.select(F.col(child_key).alias("_child"), F.struct(order, *fields).alias("_c"))
        .groupBy("_child")
        .agg(F.sort_array(F.collect_list("_c")).alias(name))
    )
    element = listed.schema[name].dataType.simpleString()
    joined = parents.join(listed, F.col(parent_key) == F.col("_child"), "left").drop("_child")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(element)))


def child_rows(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, fields: Sequence[str], name: str = "child") -> DataFrame:
    """One row per parent and child, with NULL for a parent without any: for any number of children."""
    listed = children.select(F.col(child_key).alias("_child"), F.struct(*fields).alias(name))
    return parents.join(listed, F.col(parent_key) == F.col("_child"), "left").drop("_child")


# Object lists of a repository document and the table each becomes.
REPOSITORY_OBJECTS = {
    "external_asset_graph_data": "assets",
    "external_asset_checks": "asset_checks",
    "external_partition_set_datas": "partitions",
    "external_pipeline_datas": "pipelines",
    "external_schedule_datas": "schedules",
    "external_sensor_datas": "sensors",
    "external_resource_data": "resources",
    "external_job_refs": "jobs",
}


def repository_documents(docs: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Workspace documents (``key``, ``body`` as JSON) to one row per repository.

    A document lists its repositories inline or points to stored snapshots; the pointed-to files come as
    ``snapshots`` (uri, body). Any other document is an error, as is a pointer without a file.
    """
    inline = F.get_json_object("body", "$.repository_datas")
    pointers = F.get_json_object("body", "$.repositories")
    bad = F.raise_error(F.concat(F.lit("unknown document layout: "), F.col("key")))
    checked = docs.select(
        "key", inline.alias("_inline"), F.when(inline.isNull(), F.coalesce(pointers, bad.cast("string"))).alias("_pointers")
    )
    item = "array<struct<repo_name:string,external_repository_data:string>>"
    whole = checked.filter(F.col("_inline").isNotNull()).select("key", F.posexplode(F.from_json("_inline", item)))
    unnamed = F.concat(F.lit("__UNKNOWN_"), F.col("pos").cast("string"), F.lit("__"))
    out = whole.select(
        "key",
        F.coalesce("col.repo_name", unnamed).alias("repo_name"),
        F.col("col.external_repository_data").alias("data"),
    )
    if snapshots is not None:
        stored = "array<struct<name:string,stored_snapshot:struct<uri:string,format:string>>>"
        refs = checked.filter(F.col("_inline").isNull()).select("key", F.explode(F.from_json("_pointers", stored)).alias("r"))
        refs = refs.select("key", F.col("r.name").alias("repo_name"), F.col("r.stored_snapshot.uri").alias("uri"))
        found = refs.join(snapshots.select("uri", F.col("body").alias("data")), "uri", "left")
        missing = F.raise_error(F.concat(F.lit("no snapshot file "), F.col("uri"))).cast("string")
        out = out.unionByName(found.select("key", "repo_name", F.coalesce("data", missing).alias("data")))
    return out


def repository_objects(repositories: DataFrame, objects: Mapping[str, str] | None = None) -> DataFrame:
    """One row per object of every kind: key, repo_name, kind, position, object as JSON.

    Filter on ``kind`` for one table; the document is parsed once for all kinds.
    """
    objects = dict(objects or REPOSITORY_OBJECTS)
    schema = "struct<" + ",".join(f"`{k}`:array<string>" for k in objects) + ">"
    parsed = repositories.select("key", "repo_name", F.from_json("data", schema).alias("d"))
    lists = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(f"d.`{k}`").alias("items")) for k, n in objects.items()])
    kinds = parsed.select("key", "repo_name", F.explode(lists).alias("k"))
    return kinds.select("key", "repo_name", "k.kind", F.posexplode("k.items").alias("position", "object"))


def text_document(title: Column, body: Column, comments: Column) -> Column:
    """Issue text: title, body and every comment on its own line."""
    lines = F.aggregate(comments, F.lit(""), lambda acc, c: F.concat(acc, c, F.lit("\n")))
    text = F.concat(F.lit("ISSUE TITLE: "), title, F.lit("\nBODY: "), body, F.lit("\n---\nCOMMENTS: "), lines)
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def discussion_document(title: Column, question: Column, answer: Column) -> Column:
    answered = F.coalesce(answer, F.lit("UNANSWERED"))
    text = F.concat(F.lit("DISCUSSION TITLE: "), title, F.lit("\nQUESTION: "), question, F.lit("\nANSWER: "), answered)
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def label_list(labels: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(labels, ","), F.lit("")), F.lit("None"))


def list_contains(ids: Column, wanted: str, separator: str = ";") -> Column:
    return F.array_contains(F.split(ids, separator), wanted)


def flat_record(df: DataFrame, columns: Mapping[str, str], as_text: Sequence[str] = ()) -> DataFrame:
    """Nested record to flat columns {new name: path}; structs listed in ``as_text`` become JSON text."""
    return df.select(*[(F.to_json(p) if n in as_text else F.col(p)).alias(n) for n, p in columns.items()])


def last_of_series(scope: Column, points: Column) -> list[Column]:
    """Suffix of the scope after its last ':' and the value of the last point."""
    return [F.element_at(F.split(scope, ":"), -1).alias("entity"), F.element_at(points, -1).getField("value").alias("value")]
