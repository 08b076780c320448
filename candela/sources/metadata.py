"""Flatten nested JSON objects (payload metadata, event properties) to a tall table.

Output rows ``(id columns..., path, value, type)``: objects give ``a.b``
paths, array elements ``k[i]``; leaves that are strings, integers, doubles or
booleans are kept (value as text), NULL leaves and empty containers give no
row.  ``legacy_paths=True`` writes array elements the way the source did,
repeating the key after the index (``k[i].k``).

Runs on VARIANT values: one aggregate finds the largest nesting depth (one
integer to the driver). Documents nested up to ``STEPS`` deep are one lazy chain
of as many generator steps; deeper ones are read apart, ``STEPS`` levels at a
time: what is still a container after those is written and goes on, what is a
leaf is done. So the plan of the others does not grow with the deepest document.
Documents that are no JSON object give no row; ``malformed_json`` lists them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.plans.segments import PREFIX, q, refuse_own_names
from candela.session import ensure_checkpoint_dir, stored

#: Levels of nesting that one plan takes apart.
STEPS = 16


def nesting(json_col: Column) -> Column:
    """How deep containers lie in each other in a JSON text (brackets inside its strings do not count)."""
    brackets = F.regexp_replace(F.regexp_replace(json_col, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def step(s: Column, b: Column) -> Column:
        at = s["at"] + F.when(b.isin("[", "{"), 1).when(b == "", 0).otherwise(-1)
        return F.struct(at.alias("at"), F.greatest(s["most"], at).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda s: s["most"])


def malformed_json(df: DataFrame, json_col: str, id_cols: Sequence[str]) -> DataFrame:
    """Rows that ``flatten_json`` has no leaves of because of their form: id columns, the text and ``reason``.

    ``null`` (no document), ``not json``, or ``not an object``.
    """
    v = F.try_parse_json(F.col(json_col))
    reason = (
        F.when(F.col(json_col).isNull(), "null")
        .when(v.isNull(), "not json")
        .when(F.try_variant_get(v, "$", "map<string,variant>").isNull(), "not an object")
    )
    return df.select(*[F.col(c) for c in id_cols], F.col(json_col), reason.alias("reason")).filter(F.col("reason").isNotNull())


def _leaf_type(v: Column) -> Column:
    """JSON leaf kind.  VARIANT keeps integer literals as integers and any number
    written with a point as DECIMAL (trailing zeros stripped: ``2.0`` is
    DECIMAL(1,0)), so DECIMAL means a double in the document, except integer
    literals too long for BIGINT."""
    s = F.schema_of_variant(v)
    big_int = s.rlike(r"^DECIMAL\((19|[2-9][0-9]|[0-9]{3,}),0\)$")
    return (
        F.when(s == "STRING", "string")
        .when(s.isin("TINYINT", "SMALLINT", "INT", "BIGINT") | big_int, "int")
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), "double")
        .when(s == "BOOLEAN", "boolean")
    )


def _as_obj(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _as_arr(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _descend(rows: DataFrame, ids: Sequence[Column], levels: int, legacy_paths: bool) -> DataFrame:
    """One linear chain of generators: at each level a container becomes its
    children and a leaf passes through unchanged.  No unions, so the input is
    read once and nothing is recomputed per level."""
    path, key, val = (F.col(PREFIX + c) for c in ("path", "key", "v"))

    def part(p: Column, k: Column, v: Column) -> Column:
        return F.struct(p.alias(PREFIX + "path"), k.alias(PREFIX + "key"), v.alias(PREFIX + "v"))

    def arr_child(x: Column, i: Column) -> Column:
        idx = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        return part(F.concat(idx, F.lit("."), key) if legacy_paths else idx, key, x)

    def obj_child(e: Column) -> Column:
        return part(F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])), e["key"], e["value"])

    for _ in range(levels):
        kids = (
            F.when(_as_obj(val).isNotNull(), F.transform(F.map_entries(_as_obj(val)), obj_child))
            .when(_as_arr(val).isNotNull(), F.transform(_as_arr(val), arr_child))
            .otherwise(F.array(part(path, key, val)))
        )
        rows = rows.select(*ids, F.inline(kids))
    return rows


def flatten_json(
    df: DataFrame,
    json_col: str,
    id_cols: Sequence[str],
    *,
    legacy_paths: bool = False,
    steps: int = STEPS,
) -> DataFrame:
    """Rows ``(id columns..., path, value, type)`` of the leaves; ``steps``: levels in one plan."""
    refuse_own_names(df)
    ids = [F.col(q(c)) for c in id_cols]
    val = F.col(PREFIX + "v")
    depth = df.filter(F.try_parse_json(json_col).isNotNull()).agg(F.max(nesting(F.col(json_col)))).first()[0] or 0

    def roots(of: DataFrame) -> DataFrame:
        parsed = of.select(*ids, F.try_parse_json(json_col).alias(PREFIX + "v")).filter(_as_obj(val).isNotNull())
        return parsed.select(*ids, F.lit("").alias(PREFIX + "path"), F.lit("").alias(PREFIX + "key"), val)

    if depth <= steps:
        rows = _descend(roots(df), ids, depth, legacy_paths)
    else:
        ensure_checkpoint_dir(df.sparkSession)
        deep = nesting(F.col(json_col)) > steps
        rows = _descend(roots(df.filter(~deep)), ids, steps, legacy_paths)
        left = roots(df.filter(deep))
        for low in range(0, depth, steps):
            done = stored(_descend(left, ids, min(steps, depth - low), legacy_paths))
            inner = _as_obj(val).isNotNull() | _as_arr(val).isNotNull()
            rows, left = rows.unionByName(done.filter(~inner)), done.filter(inner)

    typed = rows.select(*ids, F.col(PREFIX + "path").alias("path"), val, _leaf_type(val).alias("type"))
    # doubles print as JVM doubles (2.0, 1.0E7); other leaves as their text
    value = F.when(F.col("type") == "double", F.variant_get(val, "$", "double").cast("string")).otherwise(F.variant_get(val, "$", "string"))
    return typed.filter(F.col("type").isNotNull()).select(*ids, "path", value.alias("value"), "type")
