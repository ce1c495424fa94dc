"""Benchmark decontamination by templates, with built-in functions only.

Numbers, names and units of measure become typed placeholders, so a question whose
parameters were changed keeps its template. Windows of template tokens are joined by
hash with those of the benchmark. A match counts only if its slots are consistent: along
one alignment each benchmark value always stands for the same value of the text, and
different values for different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.llm.shared import free_names, let, stored

WINDOW = 8
LEAST_LITERAL = 4  # a template of mostly placeholders says nothing; such a window is known by its values
COVERAGE = 0.5
RUN = 13  # so many consecutive tokens of an item are a leak, whatever share of it they are
FLAGS = 1 << 14
BROADCAST_WINDOWS = 200_000  # about 10 MB; larger benchmarks are merged
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
# Units of measure that may follow a number. Fixed values.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb ml cl dl l s ms min h hr hrs d kb mb gb tb w kw kwh v hz khz mhz ghz "
    "meter meters metre metres mile miles inch inches foot feet yard yards gram grams kilogram kilograms ounce ounces "
    "pound pounds liter liters litre litres second seconds minute minutes hour hours day days week weeks month months "
    "year years dollar dollars euro euros cent cents percent degree degrees"
).split()

_NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
# a capitalised word that follows another word, a comma, a colon or a semicolon
_NAME = r"(?<=[\p{L}\p{N},;:][ \t])\p{Lu}\p{L}*"
_UNIT = rf"({NUMBER}\s*)(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?!\p{{L}})"


def plain(text: Column) -> Column:
    """The text without placeholder characters of its own; NULL is empty."""
    out = F.coalesce(text, F.lit(""))
    for mark in (NUMBER, NAME, UNIT):
        out = F.replace(out, F.lit(mark), F.lit(" "))
    return out


def values(text: Column) -> Column:
    """The letter runs and numbers of the text in order, lower-cased."""
    return F.regexp_extract_all(F.lower(plain(text)), F.lit(rf"{_NUMBER}|\p{{L}}+"), F.lit(0))


def template(text: Column) -> Column:
    """The same tokens with numbers, names and units as placeholders."""
    out = F.regexp_replace(plain(text), _NAME, NAME)
    out = F.regexp_replace(out, _NUMBER, f" {NUMBER} ")
    out = F.regexp_replace(out, _UNIT, f"$1{UNIT}")
    return F.array_remove(F.split(F.lower(out), rf"[^\p{{L}}{NUMBER}-{UNIT}]+"), "")


def window_hashes(tokens: Column, width: int) -> Column:
    """64-bit hash of each window of ``width`` tokens; ``tokens`` is a lambda's variable."""
    each = F.transform(tokens, lambda t, i: F.xxhash64(t, *[F.get(tokens, i + k) for k in range(1, width)]))
    return F.slice(each, F.lit(1), F.greatest(F.size(tokens) - width + 1, F.lit(0)))


def slots(tokens: Column, texts: Column) -> Column:
    """(at, value) of the placeholders."""
    marked = F.transform(
        tokens, lambda t, i: F.named_struct(F.lit("at"), i, F.lit("value"), F.get(texts, i), F.lit("kind"), t)
    )
    return F.transform(
        F.filter(marked, lambda m: m["kind"].isin(NUMBER, NAME, UNIT)),
        lambda m: F.named_struct(F.lit("at"), m["at"], F.lit("value"), m["value"]),
    )


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(hash, item_id, at, width, by_value, n_windows, n_templates, item_slots) of each item.

    An item shorter than ``width`` is one window. The hash is that of the template. Windows of fewer literal tokens than the rule asks have the hash of
    their values instead (``by_value``), so every item with text can be found; ``n_templates`` counts the
    others. Items without text, and repeated items, add nothing.
    """
    tokens = benchmark.select("item_id", template(F.col("text")).alias("tokens"), values(F.col("text")).alias("texts"))
    tokens = tokens.filter(F.size("tokens") > 0).withColumn("width", F.least(F.lit(width), F.size("tokens")))
    tokens = tokens.withColumn("item_slots", slots(F.col("tokens"), F.col("texts")))
    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("width"))
    each = tokens.select("*", F.explode(starts).alias("at"))
    part = F.slice("tokens", F.col("at") + 1, F.col("width"))
    literal = F.size(F.filter(part, lambda t: ~t.isin(NUMBER, NAME, UNIT)))
    each = each.withColumn("by_value", literal < F.least(F.lit(LEAST_LITERAL), F.ceil(F.col("width") / 2)))
    hashed = F.lit(None).cast("long")
    for n in range(1, width + 1):
        by_template = F.xxhash64(*[F.get("tokens", F.col("at") + k) for k in range(n)])
        by_value = F.xxhash64(*[F.get("texts", F.col("at") + k) for k in range(n)])
        own = F.when(F.col("by_value"), by_value).otherwise(by_template)
        hashed = F.when(F.col("width") == n, own).otherwise(hashed)
    each = each.select(hashed.alias("hash"), "item_id", "at", "width", "by_value", "item_slots")
    each = each.dropDuplicates(["hash", "item_id", "at"])
    counts = each.groupBy("item_id").agg(
        F.count("*").alias("n_windows"), F.count_if(~F.col("by_value")).alias("n_templates")
    )
    return each.join(counts, "item_id")


def flags_of(windows: DataFrame, flags: int) -> DataFrame:
    """One row, one array of ``flags`` booleans: whether a benchmark window has that hash bucket.

    Only spares the explosion of windows that cannot match; a full array spares none.
    """
    some = windows.select(F.pmod("hash", F.lit(flags)).alias("id")).distinct().withColumn("set", F.lit(True))
    full = windows.sparkSession.range(flags).join(some, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("set", F.lit(False)).alias("set"))))
    return full.agg(F.transform(pairs, lambda p: p["set"]).alias("flags"))


def matches(
    docs: DataFrame, windows: DataFrame, flags: int = FLAGS, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """(doc_id, row_hash, item_id, n_windows, n_templates, shift, at, by_value, doc_slots, item_slots) of each match."""
    known = windows.agg(F.count("*").alias("n"), F.collect_set(F.struct("width", "by_value")).alias("kinds")).first()
    known_flags = flags_of(windows, flags).scalar() if known["n"] else F.lit(None).cast("array<boolean>")
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("row_hash"),
        template(F.col("text")).alias("tokens"),
        values(F.col("text")).alias("texts"),
        known_flags.alias("flags"),
    )

    def hits(width: int, by_value: bool):
        def of(tokens: Column) -> Column:
            marked = F.transform(
                window_hashes(tokens, width),
                lambda h, i: F.named_struct(
                    *[F.lit("hash"), h, F.lit("at"), i, F.lit("width"), F.lit(width)],
                    *[F.lit("by_value"), F.lit(by_value)],
                ),
            )
            return F.filter(marked, lambda m: F.get(F.col("flags"), F.pmod(m["hash"], F.lit(flags)).cast("int")))

        return let(F.col("texts" if by_value else "tokens"), of)

    none = F.array().cast("array<struct<hash:bigint,at:int,width:int,by_value:boolean>>")
    found = F.concat(none, *[hits(*kind) for kind in sorted(map(tuple, known["kinds"]))])
    # arrays first, once per text; the outer form, so that no inferred filter builds them twice
    each = rows.select(
        "doc_id",
        "row_hash",
        let(F.col("tokens"), lambda t: let(F.col("texts"), lambda v: slots(t, v))).alias("slots"),
        found.alias("hits"),
    )
    each = each.select("doc_id", "row_hash", "slots", F.explode_outer("hits").alias("hit")).filter("hit IS NOT NULL")
    each = each.select(
        "doc_id",
        "row_hash",
        "slots",
        F.col("hit.hash").alias("hash"),
        F.col("hit.at").alias("doc_at"),
        F.col("hit.width").alias("width"),
        F.col("hit.by_value").alias("by_value"),
    )
    side = F.broadcast(windows) if known["n"] <= broadcast_windows else windows.hint("merge")

    def inside(column: str, at: str) -> Column:
        """The slots within the matched window, by their place in the item."""
        own = F.filter(column, lambda s: (s["at"] >= F.col(at)) & (s["at"] < F.col(at) + F.col("width")))
        return F.transform(
            own,
            lambda s: F.named_struct(F.lit("at"), s["at"] - F.col(at) + F.col("at"), F.lit("value"), s["value"]),
        )

    joined = each.join(side, ["hash", "width", "by_value"])
    return joined.select(
        "doc_id",
        "row_hash",
        "item_id",
        "n_windows",
        "n_templates",
        (F.col("doc_at") - F.col("at")).alias("shift"),
        "at",
        "by_value",
        # equal values: the text may have other kinds of placeholder there
        F.when(F.col("by_value"), inside("item_slots", "at")).otherwise(inside("slots", "doc_at")).alias("doc_slots"),
        inside("item_slots", "at").alias("item_slots"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, width: int = WINDOW) -> DataFrame:
    """(doc_id, row_hash, item_id, n_matched, coverage, changed_slots) of each leak: a row per text and item.

    A text leaks an item if consistent alignments match at least ``coverage`` of its windows, or of those known
    by their template, or all but the ``width`` windows that one changed token spoils, or if one of them matches
    ``RUN`` consecutive tokens. Items of fewer than ``2 * width`` tokens have no window beside a change in the
    middle. ``coverage`` in the result is the share of all windows.
    ``changed_slots`` counts parameters with another value than in the item. NULL and empty
    texts leak nothing, nor does an empty benchmark. Equal rows come back once per item.
    """
    windows = stored(benchmark_windows(benchmark, width), "benchmark-windows")
    found = matches(docs, windows)
    key = ["doc_id", "row_hash", "item_id", "n_windows", "n_templates", "shift"]
    # one alignment has at most the item's windows and slots
    aligned = found.groupBy(*key).agg(
        F.array_sort(F.collect_set("at")).alias("at"),
        F.collect_set(F.when(~F.col("by_value"), F.col("at"))).alias("templates"),
        F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("item_slots", "doc_slots")))).alias("pairs"),
    )
    plainly = F.transform(
        "pairs", lambda p: F.named_struct(F.lit("item"), p["item_slots"]["value"], F.lit("doc"), p["doc_slots"]["value"])
    )
    aligned = aligned.withColumn("mapping", F.array_distinct(plainly))
    one_to_one = (F.size("mapping") == F.size(F.array_distinct(F.transform("mapping", lambda m: m["item"])))) & (
        F.size("mapping") == F.size(F.array_distinct(F.transform("mapping", lambda m: m["doc"])))
    )
    changed = F.size(F.filter("mapping", lambda m: ~m["item"].eqNullSafe(m["doc"])))
    steps = max(RUN - width, 0)
    long_run = F.exists(
        F.transform("at", lambda a, i: F.coalesce(F.get(F.col("at"), i + steps) == a + steps, F.lit(False))),
        lambda whole: whole,
    ) & (F.lit(width) <= F.lit(RUN))
    item = ["doc_id", "row_hash", "item_id", "n_windows", "n_templates"]

    def matched(column: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(column))))

    per_item = (
        aligned.filter(one_to_one)
        .select(*item, "at", "templates", changed.alias("changed"), long_run.alias("long_run"))
        .groupBy(*item)
        .agg(
            matched("at").alias("n_matched"),
            matched("templates").alias("n_matched_templates"),
            F.max("long_run").alias("long_run"),
            F.sum("changed").alias("changed_slots"),
        )
    )
    share = F.col("n_matched") / F.col("n_windows")
    of_templates = (F.col("n_templates") > 0) & (F.col("n_matched_templates") >= coverage * F.col("n_templates"))
    one_change = (F.col("n_windows") > width) & (F.col("n_matched") >= F.col("n_windows") - width)
    leak = (share >= coverage) | of_templates | one_change | F.col("long_run")
    return per_item.filter(leak).select(
        "doc_id",
        "row_hash",
        "item_id",
        F.col("n_matched").cast("long"),
        share.alias("coverage"),
        F.col("changed_slots").cast("long"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that leak no item, columns unchanged."""
    h, k_id, k_hash = free_names(docs, "_text_hash", "_k_id", "_k_hash")
    found = contaminated(docs, benchmark, **options)
    found = found.select(F.col("doc_id").alias(k_id), F.col("row_hash").alias(k_hash)).distinct()
    rows = docs.withColumn(h, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_hash))
    return rows.join(found, same, "left_anti").select(*docs.columns)
