"""Keyed merges of a batch into a table, without row-level table formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart import schemas
from edmart.operators.audit import audit_columns, created_values, is_audited
from edmart.operators.joins import lookup_join
from edmart.operators.lineage import cut_if_computed


def failing(spark: SparkSession, problem: Column, shape: DataFrame) -> DataFrame:
    """No rows in the shape of ``shape``; the job fails with ``problem`` unless that is NULL.

    ``problem`` is a scalar subquery. Added to a result by a union this is the one node
    of the plan that raises, wherever and however often the checked rows are used.
    """
    stop = F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(False))
    return spark.range(1).filter(stop).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in shape.schema])


def repeated_key(df: DataFrame, keys: Sequence[str], what: str = "source") -> Column:
    """A message about one key that occurs more than once, or NULL; only keys are counted, map-side first."""
    message = F.concat(
        F.lit(f"{what} has several rows for key "), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    )
    copies = df.groupBy(*keys).agg(F.count("*").alias("_copies")).filter("_copies > 1").limit(1)
    return copies.select(message.alias("problem")).scalar()


def merge_table(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] = (),
    keep_old: Sequence[str] = (),
    null_safe: Mapping[str, object] | None = None,
    defaults: Mapping[str, Column] | None = None,
    audit: str | None = None,
    user: Column | None = None,
    now: Column | None = None,
    order_inserts: bool = False,
) -> DataFrame:
    """The table after MERGE: matched rows updated, unmatched source rows inserted.

    ``update``     columns overwritten on a match, also with NULL
    ``keep_old``   columns overwritten on a match unless the source value is NULL
    ``null_safe``  key columns compared as ``COALESCE(column, value)``; any other
                   key that is NULL never matches
    ``defaults``   values of inserted rows for target columns the source lacks or
                   leaves NULL
    ``audit``      table name whose audit columns are stamped on changed rows
    ``order_inserts``  sort inserted rows by key within their partition, so that ids
                   numbered by position come out the same when a lost task is run again

    A source with two rows for one key fails. A target key may repeat (all its rows
    are updated): the updates are a left join that keeps every target row in place,
    so a small batch is broadcast by its size and the table is not shuffled, and a
    hot target key can be split. The inserts only need the keys of target that
    occur in the batch. The batch is used for updates, inserts and the check of its keys: one that comes
    out of joins or groupings is stored once first (``lineage.cut``), so its inputs are read once.
    """
    source = cut_if_computed(source, "merge-batch")
    null_safe = dict(null_safe or {})
    defaults = dict(defaults or {})
    merge_keys = [f"_key_{i}" for i in range(len(keys))]

    def key_columns() -> list[Column]:
        return [
            (F.coalesce(F.col(k), F.lit(null_safe[k])) if k in null_safe else F.col(k)).alias(m)
            for k, m in zip(keys, merge_keys)
        ]

    any_null = F.greatest(*[F.col(k).isNull() for k in keys if k not in null_safe], F.lit(False), F.lit(False))
    matchable = source.filter(~any_null)
    batch = matchable.select(*key_columns(), *source.columns)
    changes = batch.select(
        *merge_keys,
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_new_{c}") for c in dict.fromkeys([*update, *keep_old])],
    )

    joined = lookup_join(target.select("*", *key_columns()), changes, merge_keys, "left", target.columns)
    hit = F.col("_hit").isNotNull()
    stamps = _update_stamps(target, audit, user, now)
    out = []
    for c in target.columns:
        if c in update:
            value = F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c))
        elif c in keep_old:
            value = F.coalesce(f"_new_{c}", c)
        elif c in stamps:
            value = F.when(hit, stamps[c]).otherwise(F.col(c))
        else:
            value = F.col(c)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    updated = joined.select(*out)

    wanted = batch.select(*merge_keys)
    known = lookup_join(target.select(*key_columns()), wanted, merge_keys, "left_semi").distinct()
    fresh = batch.join(known, merge_keys, "left_anti").drop(*merge_keys)
    if len(null_safe) < len(keys):
        fresh = fresh.unionByName(source.filter(any_null))
    if order_inserts:
        fresh = fresh.sortWithinPartitions(*keys, *[c for c in fresh.columns if c not in keys])
    merged = updated.unionByName(insert_rows(fresh, target, defaults, audit, user, now))
    return merged.unionByName(failing(target.sparkSession, repeated_key(batch, merge_keys), merged))


def _update_stamps(target: DataFrame, audit: str | None, user: Column | None, now: Column | None) -> dict[str, Column]:
    if audit is None or not is_audited(audit):
        return {}
    stamps = {
        f"{audit}_updt_id": user if user is not None else F.current_user(),
        f"{audit}_updt_dt": now if now is not None else F.current_timestamp(),
    }
    return {c: v for c, v in stamps.items() if c in target.columns}


def insert_rows(
    rows: DataFrame,
    target: DataFrame,
    defaults: Mapping[str, Column] | None = None,
    audit: str | None = None,
    user: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """``rows`` in the shape of ``target``: defaults, creation stamps, NULL for the rest."""
    values = dict(defaults or {})
    if audit is not None and is_audited(audit):
        created = created_values(audit, user, now, values.get(f"{audit}_table_id"))
        values = {**values, **{c: v for c, v in created.items() if c in audit_columns(audit)}}
    out = []
    for c in target.columns:
        if c in rows.columns:
            value = F.coalesce(F.col(c), values[c]) if c in values else F.col(c)
        else:
            value = values.get(c, F.lit(None))
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return rows.select(*out)


def next_id(target: DataFrame, id_column: str, start: int = 1) -> Column:
    """Ids above the largest stored one, with gaps and without a global order.

    Numbered by position: use with ``order_inserts``.
    """
    top = target.agg(F.coalesce(F.max(id_column), F.lit(start - 1))).scalar()
    return top + 1 + F.monotonically_increasing_id()


def hash_id(*columns: str) -> Column:
    """Id of a row from its natural key: the same on every run."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


# --- the merges of the data model ---------------------------------------------------------

UNIVERSITY_COLUMNS = [c.name for c in schemas.UNIVERSITIES.columns[1:12]]
# Columns of a source that a new batch overwrites, and those it fills in.
SOURCE_OVERWRITTEN = ["source_type", "source_base_url", "source_schema_url"]
SOURCE_KEPT = [
    "source_crawl_depth", "include_external", "page_timeout_s", "max_concurrency",
    "url_base_exclude", "url_exclude_patterns", "is_enabled",
]


def upsert_universities(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """Key unitid; every batch column of the target is overwritten."""
    columns = [c for c in UNIVERSITY_COLUMNS if c in target.columns and c in data.columns]
    return merge_table(target, data, ["unitid"], update=columns, **options)


def upsert_programs(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """Key cipcode (text in the batch, decimal in the table)."""
    data = data.withColumn("cipcode", F.col("cipcode").try_cast(target.schema["cipcode"].dataType))
    columns = [c for c in ("program_name", "program_description") if c in data.columns]
    return merge_table(target, data, ["cipcode"], update=columns, **options)


def _upsert_fact(table: schemas.Table, measure: str, target: DataFrame, data: DataFrame, **options) -> DataFrame:
    id_column = table.primary_key[0]
    if id_column in target.columns:
        options["defaults"] = {id_column: next_id(target, id_column), **options.get("defaults", {})}
        options["order_inserts"] = True
    return merge_table(target, data, list(table.merge_key), update=[measure], **options)


def upsert_enrollment(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    return _upsert_fact(schemas.ENROLLMENT, "total_headcount", target, data, **options)


def upsert_gradrates(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    return _upsert_fact(schemas.GRADRATES, "grtotlt", target, data, **options)


def upsert_completions(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """The code arrives as text and is compared as decimal."""
    data = data.withColumn("cipcode", F.col("cipcode").try_cast(schemas.COMPLETIONS.struct["cipcode"].dataType))
    return _upsert_fact(schemas.COMPLETIONS, "total_completions", target, data, **options)


def save_courses(target: DataFrame, data: DataFrame, source_id: str | None = None, **options) -> DataFrame:
    """Key (source, code with NULL as empty, title); a NULL title never matches.

    ``source_id`` is the source of the whole batch; without it the batch carries
    ``course_source_id`` itself.
    """
    if source_id is not None:
        data = data.withColumn("course_source_id", F.lit(source_id))
    if "course_id" in target.columns and "course_id" not in data.columns:
        key = ["course_source_id", "course_code", "course_title"]
        options["defaults"] = {"course_id": hash_id(*key), **options.get("defaults", {})}
    return merge_table(
        target, data, ["course_source_id", "course_code", "course_title"],
        update=["course_description", "course_title", "course_code", "course_credits"],
        null_safe={"course_code": ""}, **options,
    )


def upsert_sources(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """Key source_name only: type and both URLs are overwritten even with NULL, settings keep old.

    New sources are enabled unless the batch says otherwise. Rows whose (name, type)
    repeats afterwards are found by ``source_conflicts``: write only if it is empty.
    """
    kept = [c for c in SOURCE_KEPT if c in data.columns and c in target.columns]
    overwritten = [c for c in SOURCE_OVERWRITTEN if c in data.columns and c in target.columns]
    defaults = {"is_enabled": F.lit(True), "source_id": hash_id("source_name", "source_type")}
    options["defaults"] = {**defaults, **options.get("defaults", {})}
    return merge_table(target, data, ["source_name"], update=overwritten, keep_old=kept, **options)


def source_conflicts(merged: DataFrame) -> DataFrame:
    """(name, type) pairs that break uniqueness: one name was stored under two types."""
    return merged.groupBy("source_name", "source_type").agg(F.count("*").alias("n")).filter("n > 1")


def source_ids(merged: DataFrame, data: DataFrame) -> DataFrame:
    """Ids of the upserted names (a name stored under two types has two)."""
    return merged.select("source_id", "source_name").join(
        data.select("source_name").distinct(), "source_name", "left_semi"
    )


def save_schemas(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """Key source."""
    defaults = {"scraper_schema_id": hash_id("scraper_schema_source_id")}
    options["defaults"] = {**defaults, **options.get("defaults", {})}
    return merge_table(target, data, ["scraper_schema_source_id"], update=["scraper_schema_json"], **options)


def save_course_taxonomy(target: DataFrame, data: DataFrame, **options) -> DataFrame:
    """Insert absent labels; stored ones are neither changed nor removed."""
    options["defaults"] = {"hydrogen_related": F.lit(False), **options.get("defaults", {})}
    key = ["course_id", "taxonomy_id"]
    labels = cut_if_computed(data.select(*key), "label-batch")
    known = target.select(*key).join(labels, key, "left_semi").distinct()
    fresh = labels.join(known, key, "left_anti")
    merged = target.unionByName(insert_rows(fresh, target, **options))
    return merged.unionByName(failing(target.sparkSession, repeated_key(labels, key, "label batch"), merged))
