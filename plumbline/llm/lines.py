"""Line deduplication by deletion neighbourhoods of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, boxed, join_groups, let, running, stage, thin, with_text, words_of

_PLACE = ("doc_id", "tie", "line_no")


def _keyed(rows: DataFrame) -> DataFrame:
    """``tie`` orders rows that share an identifier; equal rows share it too."""
    return rows.withColumn("tie", F.xxhash64("text"))


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _canonical(line: Column) -> Column:
    """The line's words joined by single spaces; most lines are that already."""
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for run in ("  ", *(c for c in SPACE if c not in " \n")):
        odd = odd | F.contains(line, F.lit(run))
    return F.when(odd, F.array_join(words_of(line), " ")).otherwise(line)


def _halves(line: Column, n: Column) -> Column:
    """Hashes of the first and the last h words, for one or two h.

    Lines of n and of n or n + 1 words that differ by one edit agree in their
    first or their last ``n // 2`` words. An odd line offers ``n // 2``, an even
    one also one less, so any such two have an h in common.
    """

    def pair(h):
        return (
            F.xxhash64(F.lit(0), h, F.call_function("substring_index", line, F.lit(" "), h)),
            F.xxhash64(F.lit(1), h, F.call_function("substring_index", line, F.lit(" "), -h)),
        )

    half = F.floor(n / 2).cast("int")
    return F.when(n % 2 == 1, F.array(*pair(half))).otherwise(F.array(*pair(half), *pair(half - 1)))


def occurrences(rows: DataFrame, min_words: int, exact_words: int | None = None) -> DataFrame:
    """``doc_id, tie, line_no, id, digest, keys`` for each line of enough words, written.

    Lines of fewer than ``min_words`` words have no ``keys``.
    """
    least = min_words if exact_words is None else min(min_words, exact_words)
    none = F.expr("array()").cast("array<long>")
    lines = rows.select("doc_id", "tie", F.posexplode(_split(F.col("text"))).alias("line_no", "line"))
    lines = lines.select(*_PLACE, _canonical(F.col("line")).alias("line"))
    spaces = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    lines = lines.withColumn("n", F.when(F.col("line") == "", 0).otherwise(spaces + 1))
    return stage(
        lines.filter(F.col("n") >= least).select(
            *_PLACE,
            F.xxhash64("line").alias("id"),
            F.substring(F.unhex(F.sha2("line", 256)), 1, 16).alias("digest"),
            F.when(F.col("n") >= min_words, _halves(F.col("line"), F.col("n"))).otherwise(none).alias("keys"),
        ),
        "lines",
    )


def _candidates(lines: DataFrame) -> DataFrame:
    """``id`` of lines that share a half with another line."""
    keys = lines.select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo != hi")
    return keys.join(shared.select("key"), "key", "left_semi").select("id").distinct()


def _same_place(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])


def _words_at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``id, digest, first, w``: the words of the lines at the given first places."""
    wanted = places.groupBy(
        F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie")
    ).agg(F.collect_set(F.struct("id", "digest", "first")).alias("own"))
    found = rows.join(wanted, _same_place(rows, wanted)).select(
        _split(F.col("text")).alias("lines"), F.explode("own").alias("o")
    )
    line = _canonical(F.get("lines", F.col("o.first.line_no")))
    return found.select("o.*", F.split(line, " ").alias("w")).dropDuplicates(["digest"])


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one word inserted, deleted or replaced turns ``a`` into ``b``, or none."""
    n, m = F.size(a), F.size(b)
    short, long = F.when(n <= m, a).otherwise(b), F.when(n <= m, b).otherwise(a)
    least = F.least(n, m)
    differs = F.zip_with(F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: x != y)
    first = F.array_position(differs, True).cast("int")
    at = F.when(first > 0, first - 1).otherwise(least)
    rest = F.slice(short, at + 1, F.greatest(least - at, F.lit(0)))
    return F.when(n == m, F.size(F.filter(differs, lambda x: x)) <= 1).otherwise(
        (F.abs(n - m) == 1) & (rest == F.slice(long, at + 2, F.greatest(least - at, F.lit(0))))
    )


def _neighbourhood(words: str) -> Column:
    """``at, v``: the hash of the line (at -1) and of it without the word at each place.

    A hash is the exclusive or of each word's hash with its place. Going from one
    deleted place to the next changes two of them, so all follow from running sums.
    """
    zero = F.lit(0).cast("long")

    def joined(hashes):
        return F.aggregate(hashes, zero, lambda a, h: a.bitwiseXOR(h))

    def variants(own, moved):
        # Change from the deleted place i - 1 to i; the first is the line without its first word.
        steps = F.zip_with(
            F.concat(F.array(zero), F.slice(own, 1, F.size(own) - 1)), moved, lambda a, b: a.bitwiseXOR(b)
        )
        deleted = let(
            joined(moved),
            lambda whole: F.transform(
                running(steps, "long", lambda a, b: a.bitwiseXOR(b)),
                lambda x, i: F.struct(i.alias("at"), x.bitwiseXOR(whole).alias("v")),
            ),
        )
        return F.concat(F.array(F.struct(F.lit(-1).alias("at"), joined(own).alias("v"))), deleted)

    return let(
        F.transform(words, lambda w, i: F.xxhash64(w, i)),
        lambda own: let(
            F.transform(words, lambda w, i: F.xxhash64(w, i - 1)), lambda moved: variants(own, moved)
        ),
    )


def _near(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``digest`` of lines with an earlier line exactly one edit away.

    Every line emits itself and all variants with one word deleted, as hashed
    keys with the deleted place. Lines with the same variant and place differ in
    one replaced word; a line equal to another's variant lacks one word of it.
    So each group needs only its earliest line, not its pairs, and each line is
    verified against the earliest of its groups.
    """
    keys = scratch.stage(
        texts.select("id", F.explode(_neighbourhood("w")).alias("x")).select("id", "x.*"), "keys"
    )
    met = keys.groupBy("v").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo != hi")
    keys = scratch.stage(
        keys.join(met.select("v"), "v", "left_semi").join(texts.select("id", "first"), "id"), "variants"
    )
    by_place = keys.groupBy("v", "at").agg(F.min(F.struct("first", "id")).alias("least"))
    by_key = by_place.groupBy("v").agg(
        F.min(F.when(F.col("at") < 0, F.col("least"))).alias("shorter"),
        F.min(F.when(F.col("at") >= 0, F.col("least"))).alias("longer"),
    )
    found = (
        keys.join(by_place, ["v", "at"])
        .join(by_key, "v")
        .select(
            "id", "first",
            F.explode(
                F.when(F.col("at") < 0, F.array("longer")).otherwise(F.array("least", "shorter"))
            ).alias("other"),
        )
        .filter(F.col("other").isNotNull() & (F.col("other.first") < F.col("first")))
        .select("id", F.col("other.id").alias("other_id")).distinct()
    )
    own = texts.select("id", "digest", F.col("w").alias("own"), F.col("first").alias("own_first"))
    other = texts.select(F.col("id").alias("other_id"), F.col("w").alias("other"), F.col("first").alias("other_first"))
    return (
        found.join(own, "id").join(other, "other_id")
        .filter((F.col("other_first") < F.col("own_first")) & within_one_edit(F.col("own"), F.col("other")))
        .select("digest").distinct()
    )


def repeated_lines(
    rows: DataFrame, min_words: int = 5, max_edits: int = 1, exact_words: int | None = None
) -> DataFrame:
    """``doc_id, tie, dropped`` (line numbers from 0) for rows with ``tie`` and ``text``."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    lines = occurrences(rows, min_words, exact_words)
    texts = lines.groupBy("digest", "id").agg(
        F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("size")
    )
    with Scratch(rows.sparkSession) as scratch:
        if max_edits:
            near_by = _candidates(lines).withColumn("close", F.lit(True))
            texts = scratch.stage(texts.join(near_by, "id", "left").filter("size > 1 or close"), "texts")
            words = scratch.stage(_words_at(rows, texts.filter("close")), "candidates")
            near = _near(words, scratch).withColumn("near", F.lit(True))
            texts = texts.join(near, "digest", "left").filter("size > 1 or near")
        else:
            texts = texts.filter("size > 1").withColumn("near", F.lit(False))
        texts = stage(texts.select("digest", "size", "first", "near"), "repeated")
    later = F.struct(*_PLACE) > F.col("first")
    return (
        join_groups(lines.select(*_PLACE, "digest"), texts, ["digest"], lines.count())
        .filter(F.coalesce("near", F.lit(False)) | later)
        .groupBy("doc_id", "tie")
        .agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def line_report(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    max_edits: int = 1,
    exact_words: int | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, dropped``.

    ``dropped`` lists the line numbers, from 0, that go: those for which an
    earlier line of the corpus has the same words or, with ``max_edits`` 1, is one
    word inserted, deleted or replaced away, whether or not that one goes itself.
    Lines are what line breaks separate, words what white space separates; lines
    of fewer than ``min_words`` words are neither compared nor dropped, unless
    ``exact_words`` is less: lines from that many words on then go if an earlier
    line has the same words. With 1 every line that is not empty counts.

    Earlier means by identifier (null first), then, for different texts of one
    identifier, by a hash of the text, then by line number. Repeated rows are one
    document and are judged alike. A null text counts as empty: one line, kept.
    An empty table gives an empty result. Other columns are ignored.

    Only lines that share half their words with another line emit deletion
    variants; two lines one edit apart always do.
    """
    rows = _keyed(thin(df, id_col, text_col))
    drops = repeated_lines(rows, min_words, max_edits, exact_words)
    slim = rows.select("doc_id", "tie", F.size(_split(F.col("text"))).cast("long").alias("n_lines"))
    none = F.expr("array()").cast("array<int>")
    return slim.join(drops, _same_place(slim, drops), "left").select(
        slim["doc_id"], "n_lines", F.coalesce("dropped", none).alias("dropped")
    )


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    max_edits: int = 1,
    exact_words: int | None = None,
) -> DataFrame:
    """The input rows without the lines that ``line_report`` drops.

    All rows stay; a text may become empty. A column ``n_chars`` follows the text.
    """
    rows = _keyed(boxed(df, id_col, text_col))
    drops = repeated_lines(rows.drop("row"), min_words, max_edits, exact_words)
    # What lies between two dropped lines, or an end of the text, stays.
    kept = let(
        _split(F.col("text")),
        lambda lines: F.flatten(
            F.zip_with(
                F.concat(F.array(F.lit(-1)), "dropped"),
                F.concat("dropped", F.array(F.size(lines))),
                lambda a, b: F.slice(lines, a + 2, b - a - 1),
            )
        ),
    )
    kept = F.array_join(kept, "\n")
    found = rows.join(drops, _same_place(rows, drops), "left").select(
        "row", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("clean")
    )
    return with_text(found, df.columns, text_col, F.col("clean"))
