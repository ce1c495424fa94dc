"""Quality rules: counting rules, then a log-likelihood ratio between trusted and raw text.

Multinomials over all hashed n-grams are counted, once over the documents that labels call good and
once over all documents, for each of three kinds: the ends of words, every overlapping character
4-gram, word borders included, and word pairs. A document's score is the mean of
``ln p_trusted(bucket) - ln p_raw(bucket)`` over all its n-grams, so long and short texts compare. The
threshold is the cut between the scores of all labelled good and all labelled bad texts that puts the fewest
of them on the wrong side. Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edmart.llm.shared import SPACES, free_names, let, stored, words

BUCKETS = 16384
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
ENDING = 3
SPAN = 4
WIDTH = 4 * SPAN  # bytes of a character n-gram at four bytes a character
PIECE = 64  # n-grams of a line hashed from one value
# Of as many n-grams one expression is the sum: generated methods stay short enough to be compiled (8,000 bytes).
TERMS = 16
KINDS = 3
SYMBOLS = "#*$%&|<>"


def bigrams(tokens: Column) -> Column:
    """64-bit hashes of each word with the next one; ``tokens`` is a lambda's variable."""
    each = F.transform(tokens, lambda t, i: F.xxhash64(t, F.get(tokens, i + 1)))
    return F.slice(each, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))


def endings(tokens: Column) -> Column:
    """64-bit hashes of the character n-gram that ends each word (the whole of a shorter word)."""
    return F.transform(tokens, lambda t: F.xxhash64(ending(t)))


def bordered(tokens: Column) -> Column:
    """The words with spaces in front, between and behind, four bytes a character (so a character has a place)."""
    space = F.lit(" ")
    return F.encode(F.concat(space, F.array_join(tokens, " "), space), "UTF-32")


def span_starts(line: Column) -> Column:
    """The byte places where the character n-grams of a line, as ``bordered`` gives it, start."""
    none = F.array().cast("array<int>")
    return F.when(F.octet_length(line) >= WIDTH, F.sequence(F.lit(1), F.octet_length(line) - (WIDTH - 1), F.lit(4))).otherwise(none)


def pieces(line: Column, length: int = PIECE) -> Column:
    """A line in pieces of up to ``length`` n-grams; every n-gram lies in one piece, so pieces overlap.

    The place of an n-gram is then found in a short value, however long the text is.
    """
    size = F.lit(4 * length + WIDTH - 4)
    none = F.array().cast("array<binary>")
    starts = F.sequence(F.lit(1), F.octet_length(line) - (WIDTH - 1), F.lit(4 * length))
    cut = F.transform(starts, lambda i: F.substring(line, i, size))
    return F.when(F.octet_length(line) >= WIDTH, cut).otherwise(none)


def ending(token: Column) -> Column:
    """The character n-gram that ends a word (the whole of a shorter word)."""
    return F.substring(token, -ENDING, ENDING)


def remainder(gram: Column, buckets: int) -> Column:
    """A hash modulo ``buckets``, 0 or more: its low bits where ``buckets`` is a power of two."""
    low = buckets & (buckets - 1) == 0
    return gram.bitwiseAND(F.lit(buckets - 1)) if low else F.pmod(gram, F.lit(buckets))


def bucket(gram: Column, buckets: int) -> Column:
    return remainder(gram, buckets).cast("int")


def span_bucket(line: Column, start: Column, buckets: int) -> Column:
    """The bucket of the character n-gram at a place: a 32-bit hash does, and there are as many of them as characters."""
    return remainder(F.hash(F.substring(line, start, F.lit(WIDTH))), buckets)


def word_buckets(tokens: Column, pairs: Column, buckets: int) -> Column:
    """The bucket of every word end and word pair; each kind has ``buckets`` of its own, one kind after the other."""
    return F.concat(
        F.transform(tokens, lambda t: bucket(F.xxhash64(ending(t)), buckets)),
        F.transform(pairs, lambda h: bucket(h, buckets) + F.lit(2 * buckets)),
    )


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all ``texts`` (good, text), counted in each task first.

    A text becomes rows: one with its word buckets, one for each piece of its line. The second step makes a row of
    each word bucket and of each place in a piece, where the n-gram is hashed in generated code.
    The outer form of explode, as its plain form has a filter inferred that builds everything twice.
    """

    def parts(tokens: Column, pairs: Column) -> Column:
        lines = F.transform(
            let(bordered(tokens), lambda line: pieces(line)),
            lambda p: F.struct(p.alias("piece"), F.array().cast("array<int>").alias("own")),
        )
        own = F.struct(F.lit(None).cast("binary").alias("piece"), word_buckets(tokens, pairs, buckets).alias("own"))
        return F.concat(lines, F.array(own))

    split = let(words(F.col("text")), lambda t: let(bigrams(t), lambda p: parts(t, p)))
    rows = texts.select("good", F.explode_outer(split).alias("part")).select("good", "part.piece", "part.own")
    is_own = F.col("piece").isNull()
    places = F.when(is_own, F.col("own")).otherwise(span_starts(F.col("piece")))
    each = rows.select("good", "piece", F.explode_outer(places).alias("at")).filter("at IS NOT NULL")
    of_span = span_bucket(F.col("piece"), F.col("at"), buckets) + F.lit(buckets)
    key = F.when(is_own, F.col("at")).otherwise(of_span).alias("bucket")
    return each.groupBy(key).agg(F.count("*").alias("raw"), F.count_if("good").alias("trusted"))


def word_weight(tokens: Column, pairs: Column, weights: Column, buckets: int) -> Column:
    """The summed weight of all word ends and word pairs; ``weights`` is a lambda's variable, as in ``mean_weight``."""

    def of(values: Column, place) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, g: acc + F.get(weights, place(g)))

    ends = of(tokens, lambda t: bucket(F.xxhash64(ending(t)), buckets))
    return ends + of(pairs, lambda h: bucket(h, buckets) + F.lit(2 * buckets))


def piece_weight(piece: Column, weights: Column, buckets: int) -> Column:
    """The summed weight of up to ``TERMS`` character n-grams of a piece, 0 for NULL, written out for generated code."""
    zero = F.lit(0.0)
    total = zero
    for k in range(TERMS):
        own = F.get(weights, span_bucket(piece, F.lit(4 * k + 1), buckets) + F.lit(buckets))
        total = total + F.when(F.octet_length(piece) >= 4 * k + WIDTH, own).otherwise(zero)
    return total


def mean_weight(tokens: Column, pairs: Column, weights: Column, buckets: int) -> Column:
    """The mean weight of all n-grams; each is hashed and weighed in one step, no list of buckets is built.

    ``weights`` is a lambda's variable: a column would be unpacked anew for each n-gram.
    """

    def weigh(line: Column) -> Column:
        def of(values: Column, place) -> Column:
            return F.aggregate(values, F.lit(0.0), lambda acc, g: acc + F.get(weights, place(g)))

        starts = span_starts(line)
        total = (
            of(tokens, lambda t: bucket(F.xxhash64(ending(t)), buckets))
            + of(starts, lambda i: span_bucket(line, i, buckets) + F.lit(buckets))
            + of(pairs, lambda h: bucket(h, buckets) + F.lit(2 * buckets))
        )
        n = F.size(tokens) + F.size(starts) + F.size(pairs)
        return F.coalesce(total / F.nullif(n, F.lit(0)), F.lit(0.0))

    return let(bordered(tokens), weigh)


def trusted(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of documents with a label of quality 1 and not toxic 1."""
    good = labels.filter((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False)))
    return good.select("doc_id").distinct().withColumn("good", F.lit(True))


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, one array of ``KINDS * buckets`` weights: ``ln p_trusted - ln p_raw``, add-one smoothed.

    Each kind of n-gram is a multinomial of its own. The counts cover every n-gram of every document
    and every label. Without any trusted text all weights are 0.
    """
    # labels grow with the corpus, so they are merged, never broadcast; texts move, as n-grams are larger
    texts = docs.select("doc_id", "text").join(trusted(labels).hint("merge"), "doc_id", "left")
    both = (
        docs.sparkSession.range(KINDS * buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(bucket_counts(texts.select("good", "text"), buckets), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("raw", "trusted")])
    )
    # a fixed number of rows meets here, whatever the size of the corpus
    per_kind = both.groupBy(F.floor(F.col("bucket") / buckets).alias("kind")).agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "trusted"))).alias("cells"),
        F.sum("raw").alias("n_raw"),
        F.sum("trusted").alias("n_trusted"),
    )
    weighed = per_kind.select(
        "kind",
        F.transform(
            "cells",
            lambda c: F.when(F.col("n_trusted") == 0, F.lit(0.0)).otherwise(
                F.ln((c["trusted"] + 1) / (F.col("n_trusted") + buckets))
                - F.ln((c["raw"] + 1) / (F.col("n_raw") + buckets))
            ),
        ).alias("own"),
    )
    kinds = weighed.agg(F.array_sort(F.collect_list(F.struct("kind", "own"))).alias("kinds"))
    return kinds.select(F.flatten(F.transform("kinds", lambda k: k["own"])).alias("weights"))


def sides(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of all labelled texts with a side: bad ones have quality 0, good ones are trusted and not bad."""
    bad = labels.filter("quality = 0").select("doc_id").distinct().withColumn("good", F.lit(False))
    return trusted(labels).join(bad.hint("merge"), "doc_id", "left_anti").unionByName(bad)


def best_cut(docs: DataFrame, labels: DataFrame, weights: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``cut``: the score from which a text is kept; every labelled text of ``docs`` with a side is scored."""
    texts = docs.select("doc_id", "text").join(sides(labels).hint("merge"), "doc_id").withColumn("w", weights.scalar())
    score = base_score(F.col("text"), F.col("w"), buckets)
    return lowest_error_cut(stored(texts.select(score.alias("llr"), "good"), "quality-marks"))


def cut_of_scores(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """``best_cut`` of texts that have their scores already: (doc_id, llr), ``llr`` as ``base_score`` gives it."""
    return lowest_error_cut(stored(scores.join(sides(labels).hint("merge"), "doc_id").select("llr", "good"), "quality-marks"))


def lowest_error_cut(marks: DataFrame) -> DataFrame:
    """One row, ``cut``, from the scores of all labelled texts (llr, good), those without a score left out.

    The rule: of all cuts between two scores the one with the fewest wrong labels, good texts below it and bad
    ones above (the lowest of equals), half-way between its neighbours. Without both sides, or where no cut is
    better than none, it is minus infinity: only the base rules decide. The scores are sorted by a range
    exchange and each part is counted on its own; only one row of each part meets the others.
    """
    steps = marks.filter("llr IS NOT NULL").groupBy("llr").agg(
        (F.count_if(~F.col("good")) - F.count_if("good")).alias("net"), F.count_if("good").alias("n_good")
    )
    # written once: running counts need fixed parts
    ranged = stored(steps.repartitionByRange("llr").withColumn("part", F.spark_partition_id()), "quality-steps")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("net").alias("own"), F.max("llr").alias("highest"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"),
        F.max("highest").over(earlier).alias("below"),
    )
    in_part = Window.partitionBy("part").orderBy("llr")
    own = F.coalesce(F.sum("net").over(in_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = ranged.withColumns({"own": own, "last": F.lag("llr").over(in_part)}).join(F.broadcast(parts), "part")
    last, gain = F.coalesce("last", "below"), F.col("before") + F.col("own")
    half = (F.col("llr") + last) / 2
    # between two neighbouring doubles there is no other
    cut = F.when(half > last, half).otherwise(F.col("llr"))
    best = F.max(F.when(gain > 0, F.struct(gain.alias("gain"), (-F.col("llr")).alias("low"), cut.alias("cut"))))
    none = F.lit(float("-inf"))
    found = at.agg(best.alias("best"), F.sum("n_good").alias("n_good"))
    return found.select(F.when(F.col("n_good") > 0, F.coalesce("best.cut", none)).otherwise(none).alias("cut"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""

    def repeats(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    def filled(lines: Column) -> Column:
        return F.filter(lines, lambda line: F.octet_length(F.btrim(line, F.lit(SPACES))) > 0)

    # only texts that repeat a line, empty ones included, pay for the search for words
    of_all = let(F.split(text, "\n"), lambda lines: F.when(repeats(lines) > 0, let(filled(lines), repeats)).otherwise(F.lit(0)))
    return of_all.cast("long")


def repeated_words(pairs: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, from the bigrams of the words.

    Windows compare by a 64-bit hash of the bigrams that make them up.
    """

    def windows(pair: Column) -> Column:
        each = F.transform(pair, lambda p, i: F.xxhash64(p, F.get(pair, i + 2), F.get(pair, i + 3)))
        return F.slice(each, F.lit(1), F.greatest(F.size(pair) - 3, F.lit(0)))

    def repeats(marks: Column) -> Column:
        def same(mark: Column, at: Column) -> Column:
            return F.coalesce(F.get(marks, at)["h"] == mark["h"], F.lit(False))

        return F.filter(marks, lambda mark, k: same(mark, k - 1) | same(mark, k + 1))

    def covered(grams: Column) -> Column:
        by_hash = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(
            F.sort_array(F.transform(let(by_hash, repeats), lambda mark: mark["i"])),
            F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(5))).alias("n")),
            lambda acc: acc["n"],
        )

    # only texts that repeat a window pay for sorting
    return let(
        windows(pairs),
        lambda grams: F.when(F.size(F.array_distinct(grams)) < F.size(grams), covered(grams)).otherwise(
            F.lit(0).cast("long")
        ),
    )


def counted(text: Column, more) -> Column:
    """The counts of one text and the columns ``more(tokens, pairs)`` as a struct; the text is split into words once."""
    whole = F.coalesce(text, F.lit(""))
    symbols = F.regexp_count(whole, F.lit("[" + SYMBOLS + "]"))

    def of(tokens: Column) -> Column:
        n = F.size(tokens)
        return let(
            bigrams(tokens),
            lambda pairs: F.struct(
                n.cast("long").alias("n_words"),
                F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                duplicate_lines(whole).alias("n_dup_lines"),
                repeated_words(pairs).alias("n_repeat_words"),
                *more(tokens, pairs),
            ),
        )

    return let(words(text), of)


def measures(text: Column, weights: Column, buckets: int) -> Column:
    """All figures of one text as a struct."""

    def score(tokens: Column, pairs: Column) -> list[Column]:
        return [let(weights, lambda w: mean_weight(tokens, pairs, w, buckets)).alias("llr")]

    return counted(text, score)


def figures(docs: DataFrame, weights: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id`` and the figures that ``measures`` gives, of every row of ``docs`` (doc_id, text); no text moves.

    A text becomes a row for each piece of its line, short enough that one expression is the sum of a piece's
    weights: generated code hashes and weighs every character n-gram. The sums of a text are added up in its task,
    by a row number, and only one row of figures a text moves.
    """

    (w,) = free_names(docs, "_weights")

    def cut(tokens: Column, pairs: Column) -> list[Column]:
        def of(line: Column) -> Column:
            spans = F.greatest(F.shiftright(F.octet_length(line), 2) - F.lit(SPAN - 1), F.lit(0))
            n = F.size(tokens) + F.size(pairs) + spans
            return F.struct(n.alias("n"), pieces(line, TERMS).alias("pieces"))

        own = let(F.col(w), lambda weights: word_weight(tokens, pairs, weights, buckets))
        return [own.alias("own"), let(bordered(tokens), of).alias("line")]

    m = F.col("m")
    rows = docs.withColumn(w, weights.scalar())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", counted(F.col("text"), cut).alias("m"))
    rows = rows.select(
        "row",
        "doc_id",
        *[m[c].alias(c) for c in (*COUNTS, "own")],
        m["line"]["n"].alias("n"),
        F.explode_outer(m["line"]["pieces"]).alias("piece"),
    ).withColumn(w, weights.scalar())
    total = piece_weight(F.col("piece"), F.col(w), buckets)
    sums = rows.groupBy("row", "doc_id", *COUNTS, "own", "n").agg(F.sum(total).alias("spans"))
    llr = F.coalesce((F.col("own") + F.col("spans")) / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0))
    return sums.select("doc_id", *COUNTS, llr.alias("llr"))


def failed(m) -> Column:
    """Whether the base rules reject a text, from its figures ``m``."""
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])


def base_score(text: Column, weights: Column, buckets: int) -> Column:
    """The ``llr`` of a text that the base rules keep, else NULL; one expression, so that each text is measured once."""
    return let(measures(text, weights, buckets), lambda m: F.when(~failed(m), m["llr"]))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame,
    corpus: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    threshold: float | None = None,
    names: dict[str, str] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` (with ``text``) and the rule counts, ``llr``, ``base_failed`` and ``kept`` of every row.

    ``corpus`` (doc_id, text) gives the raw multinomials; ``threshold`` stands in for
    the learned cut. ``names`` renames result columns; ``with_text=False`` leaves ``text`` out of the result.
    Where ``docs`` is ``corpus`` itself each text is scored once: the rows are stored with their scores
    and the cut comes from those. Where only ``doc_id`` passes through, ``figures`` measures the texts.
    NULL and empty texts have no words and fail the base rules. A NULL ``doc_id`` is judged
    like any other but never trusted; repeated rows are counted and judged each. ``llr`` is
    0 for a text without words. Other columns of ``docs`` pass through untouched.
    """
    names = {n: n for n in (*COUNTS, "llr", "base_failed", "kept")} | (names or {})
    w, m = free_names(docs, "_weights", "_measures")
    # a scalar subquery: one array of fixed size for all rows, no join
    weights = stored(bucket_weights(corpus, labels, buckets), "ngram-weights")
    if not with_text and sorted(docs.columns) == ["doc_id", "text"]:
        df = figures(docs, weights, buckets).withColumnsRenamed({n: names[n] for n in (*COUNTS, "llr")})
    else:
        df = docs.withColumn(w, weights.scalar())
        df = df.withColumn(m, measures(F.col("text"), F.col(w), buckets)).drop(w)
        df = df.withColumns({names[n]: F.col(m)[n] for n in (*COUNTS, "llr")}).drop(m)
    df = df.withColumn(names["base_failed"], failed({n: F.col(c) for n, c in names.items()}))
    df = df if with_text else df.drop("text")
    if threshold is not None:
        cut = F.lit(threshold)
    elif docs is corpus:
        df = stored(df, "quality-scores")
        of_base = F.when(~F.col(names["base_failed"]), F.col(names["llr"]))
        cut = cut_of_scores(df.select("doc_id", of_base.alias("llr")), labels).scalar()
    else:
        cut = best_cut(corpus, labels, weights, buckets).scalar()
    return df.withColumn(names["kept"], ~F.col(names["base_failed"]) & (F.col(names["llr"]) >= cut))


def keep_good(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float | None = None
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, columns unchanged; each text is scored once and stored with its score."""
    w, s = free_names(docs, "_weights", "_score")
    weights = stored(bucket_weights(docs, labels, buckets), "ngram-weights")
    df = docs.withColumn(w, weights.scalar())
    scored = stored(df.withColumn(s, base_score(F.col("text"), F.col(w), buckets)).drop(w), "quality-scores")
    if threshold is not None:
        cut = F.lit(threshold)
    else:
        cut = cut_of_scores(scored.select("doc_id", F.col(s).alias("llr")), labels).scalar()
    return scored.filter(F.col(s) >= cut).select(*docs.columns)
