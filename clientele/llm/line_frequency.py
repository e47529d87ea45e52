"""Quality rules: statistics of a text, and how much of it is boilerplate of its host.

Built-in DataFrame functions only. A line is boilerplate if too many distinct documents of
its host hold it; a document that has little left without such lines is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.scratch import stored, text_key

WHITE = r"[\x20\x09-\x0D]+"
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineLimits:
    """A line goes if more than ``min_documents`` and more than ``max_share`` of its host's
    distinct documents hold it; a document is depleted if less than ``min_left`` of the
    characters in its words is left. Shares do not depend on the size of the corpus."""

    min_documents: int = 20
    max_share: float = 0.10
    min_left: float = 0.30
    #: A line also goes if more distinct documents of its host than this hold it, whatever
    #: their share; and on any host if at least so many and more than this share do.
    always: int | None = None
    small_documents: int | None = None
    small_share: float = 0.50
    #: Parts that the rows of one line are dealt over when they look up its frequency.
    spread: int = 64


#: For texts from which lines are taken: hot and small hosts have limits of their own.
TEXT_LIMITS = LineLimits(always=1000, small_documents=5)


def with_base(docs: DataFrame, whole: Column, keep: list[Column]) -> DataFrame:
    """The columns but for the text, ``keep`` of it, its statistics and ``base_failed``."""
    names = [c for c in docs.columns if c != "_text"]
    words = F.filter(F.split(whole, WHITE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        *names,
        *keep,
        words.alias("_words"),
        lines.alias("_lines"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    names = [c for c in step.columns if c not in ("_words", "_lines")]
    w = F.col("_words")
    # Windows of three words by hash. The last two entries are cut off again.
    grams = F.slice(
        F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
        F.lit(1),
        F.greatest(F.size(w) - 2, F.lit(0)),
    )
    step = step.select(
        *names,
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        grams.alias("_grams"),
    )
    g = F.col("_grams")
    has_repeats = F.size(F.array_distinct(g)) < F.size(g)
    pairs = F.when(
        has_repeats,
        F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    step = step.withColumn("_pairs", pairs).drop("_grams")
    p = F.col("_pairs")
    repeated = F.filter(
        p,
        lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]),
    )
    step = step.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("_pairs")
    # Each window adds the words that the window before does not hold.
    covered = F.aggregate(
        F.col("_at"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(
            x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_at")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return step.withColumn("base_failed", failed)


def normalised_line(line: Column) -> Column:
    """Stripped of white space, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACES)), _AZ, _AZ.lower())


def boilerplate_lines(lines: DataFrame, hosts: DataFrame, limits: LineLimits) -> DataFrame:
    """``of_host, of_key`` of the lines above the limits. Documents of one text count once."""
    counts = lines.groupBy("host", "line_key").agg(F.countDistinct("text_key").alias("documents"))
    n, share = F.col("documents"), F.col("documents") / F.col("host_documents")
    least, above = n > limits.min_documents, (n > limits.min_documents) & (n > limits.max_share * F.col("host_documents"))
    if limits.always is not None:
        least, above = least | (n > limits.always), above | (n > limits.always)
    if limits.small_documents is not None:
        least = least | (n >= limits.small_documents)
        above = above | ((n >= limits.small_documents) & (share > limits.small_share))
    return (
        counts.where(least).join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .where(above)
        .select("of_host", F.col("line_key").alias("of_key"))
    )


def _texts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        text_key(F.col(text_col)).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )


def _lines(text: Column) -> Column:
    """The lines with a word as structs of their hash and the characters in their words."""
    return F.transform(
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.struct(
            F.xxhash64(normalised_line(x)).alias("line_key"),
            F.length(F.regexp_replace(x, WHITE, "")).cast("bigint").alias("chars"),
        ),
    )


def _lost(marked: DataFrame, limits: LineLimits, *more: Column) -> DataFrame:
    """``of_row, lost``: what boilerplate lines take from the rows of ``marked`` that have any;
    and ``more`` of those lines."""
    hosts = marked.groupBy(F.col("host").alias("of_host")).agg(
        F.countDistinct("text_key").alias("host_documents")
    )
    rows = marked.select("row_id", "host", "text_key", F.inline("lines"))
    frequent = boilerplate_lines(rows, hosts, limits)
    # A frequent line has very many rows; they are dealt over several parts, and the short
    # list of such lines is repeated for each.
    salts = F.sequence(F.lit(0), F.lit(limits.spread - 1))
    return (
        rows.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(limits.spread)).cast("int"))
        .join(
            frequent.withColumn("of_salt", F.explode(salts)),
            F.col("host").eqNullSafe(F.col("of_host"))
            & (F.col("line_key") == F.col("of_key"))
            & (F.col("salt") == F.col("of_salt")),
        )
        .groupBy(F.col("row_id").alias("of_row"))
        .agg(F.sum("chars").alias("lost"), *more)
    )


def quality_report(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Per document ``doc_id, host, text_key``, its statistics, ``base_failed``, how many
    characters in words its host's boilerplate lines take (``lost_chars``), and ``kept``.

    A null text is an empty one, which fails. Documents without a host are one host's; a null
    id stays null. Repeated rows each get their row. Other columns are not looked at; an
    empty table gives no rows.
    """
    own = _texts(docs, id_col, text_col, host_col)
    # The texts are read once; from here on there are hashes and counts only.
    marked = stored(
        with_base(own, F.col("_text"), [_lines(F.col("_text")).alias("lines")]).withColumn(
            "row_id", F.monotonically_increasing_id()
        ),
        "statistics",
    )
    lost_chars = F.coalesce("lost", F.lit(0)).cast("bigint")
    left = F.col("word_chars") - lost_chars
    return (
        marked.drop("lines")
        .join(_lost(marked, limits), F.col("row_id") == F.col("of_row"), "left")
        .withColumn("lost_chars", lost_chars)
        .withColumn("kept", ~F.col("base_failed") & (left >= limits.min_left * F.col("word_chars")))
        .drop("row_id", "of_row", "lost")
    )


def keep_good_documents(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """The documents that ``quality_report`` keeps, all columns and whole texts as they were.

    What fails by its own text goes on the way, so that only the depleted documents are
    looked up and texts need not be shuffled while those are few.
    """
    own = _texts(docs, id_col, text_col, host_col)
    marked = stored(
        own.withColumn("lines", _lines(F.col("_text")))
        .drop("_text")
        .withColumn("row_id", F.monotonically_increasing_id()),
        "host_lines",
    )
    chars = F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, x: n + x["chars"])
    lost = marked.join(_lost(marked, limits), F.col("row_id") == F.col("of_row"))
    # Stored, so that Spark knows how many there are when it chooses the join.
    depleted = stored(
        lost.where(chars - F.col("lost") < limits.min_left * chars)
        .select("doc_id", "host", "text_key")
        .distinct(),
        "depleted",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(
        row,
        F.col(id_col).cast("bigint").alias("own_id"),
        F.col(host_col).cast("string").alias("own_host"),
        text_key(F.col(text_col)).alias("own_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    # The row number keeps Spark from moving the filter into the expressions that the
    # statistics are made of, where it would compute them over and over.
    numbered = with_base(whole, F.col("_text"), []).withColumn("row_no", F.monotonically_increasing_id())
    passed = numbered.where(~F.col("base_failed") & (F.col("row_no") >= 0))
    same = (
        F.col("own_id").eqNullSafe(F.col("doc_id"))
        & F.col("own_host").eqNullSafe(F.col("host"))
        & (F.col("own_key") == F.col("text_key"))
    )
    return passed.join(depleted, same, "left_anti").select("row.*")


def drop_boilerplate(
    docs: DataFrame,
    limits: LineLimits = TEXT_LIMITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """The documents without the lines above the limits, and without the documents that are
    depleted then; all other columns as they were, ``kept_lines`` and ``lost_lines`` added.

    Lines are told apart as ``quality_report`` does. Lines without a word stay. A null text is
    an empty one, which is not depleted, and stays null. Documents without a host are one
    host's; rows that repeat an id, host and text share their result; an empty table gives no
    rows. Built-in functions only.
    """
    own = _texts(docs, id_col, text_col, host_col)
    marked = stored(
        own.withColumn("lines", _lines(F.col("_text")))
        .drop("_text")
        .withColumn("row_id", F.monotonically_increasing_id()),
        "host_lines",
    )
    lost = _lost(marked, limits, F.collect_set("line_key").alias("_gone"))
    chars = F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, x: n + x["chars"])
    keys = {"doc_id": "_of_id", "host": "_of_host", "text_key": "_of_key"}
    # Stored, so that Spark knows how many there are when it chooses the join.
    found = stored(
        marked.join(lost, F.col("row_id") == F.col("of_row"))
        .select(
            *[F.col(k).alias(v) for k, v in keys.items()],
            "_gone",
            (chars - F.col("lost") < limits.min_left * chars).alias("_depleted"),
        )
        .dropDuplicates(list(keys.values())),
        "boilerplate",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    whole = docs.select(
        row,
        F.col(id_col).cast("bigint").alias("_own_id"),
        F.col(host_col).cast("string").alias("_own_host"),
        text_key(F.col(text_col)).alias("_own_key"),
    )
    same = (
        F.col("_own_id").eqNullSafe(F.col("_of_id"))
        & F.col("_own_host").eqNullSafe(F.col("_of_host"))
        & (F.col("_own_key") == F.col("_of_key"))
    )
    text = F.col(f"_row.`{text_col}`")
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    worded = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    left = F.filter(
        lines, lambda x: ~(worded(x) & F.array_contains("_gone", F.xxhash64(normalised_line(x))))
    )
    # Sorted and merged at every size: the list is as long as the corpus makes it.
    joined = whole.join(found.hint("merge"), same, "left").where(~F.coalesce("_depleted", F.lit(False)))
    joined = joined.select(
        "_row", F.size(lines).alias("_all"), F.when(F.col("_gone").isNotNull(), left).alias("_left")
    )
    text = F.when(F.col("_left").isNull(), text).otherwise(F.array_join("_left", "\n"))
    kept = F.when(F.col("_left").isNull(), F.col("_all")).otherwise(F.size("_left")).cast("bigint")
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns],
        kept.alias("kept_lines"),
        (F.col("_all") - kept).cast("bigint").alias("lost_lines"),
    )
