"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one text: too few words, or most words inside repeated three-word windows.
The method looks at all texts: lines are normalised and hashed, and for every host the distinct
documents holding a line are counted. A line above both limits is boilerplate of that host and is
removed; a document that loses too much is depleted and rejected.

Near copies of one page make its lines frequent and so deplete each other. :func:`_spared` keeps
representatives of them: the depleted holders of a line count as one document, and a line that is
then within the limits is no boilerplate but content; the smallest text among its depleted holders
keeps all such lines, so that later stages see the page.

One pass reads the texts and stores a narrow row for each: its counts and, per line, a
64-bit key and its words. All that follows works on these rows. Counting is pre-aggregated
in the map tasks, so a line or a text that a third of all rows share costs one row per task; the
joins go through :func:`lookup_join`, which salts hot keys.

Defined results: a null or empty text has no words and fails the base rules; a null host is a host
of its own; exact copies within a host count as one document; equal rows get equal verdicts; other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import stored
from aerolag.operators.joins import lookup_join

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A line is boilerplate of a host if more than LINE_DOCS distinct documents of it, and more than
# LINE_PERCENT of its distinct documents, hold the line.
LINE_DOCS = 10
LINE_PERCENT = 2
# A document is depleted if fewer than MIN_WORDS words or less than this share of them remain.
MIN_LEFT_PERCENT = 50

_SPACE = r"[\x20\x09-\x0D]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")


def _covered(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def positions(keys: Column) -> Column:
        """Positions, in order, of the windows that are not alone."""
        pairs = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return _let(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            p,
                            lambda x, j: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(p, j + 1)["k"] == x["k"], F.lit(False))
                                    | F.coalesce(F.get(p, j - 1)["k"] == x["k"], F.lit(False))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def reach(found: Column) -> Column:
        # A window adds its three words, less those that the next one begins with.
        steps = F.transform(
            found, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(found, j + 1) - x, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def of_windows(keys: Column) -> Column:
        repeated = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(repeated, _let(positions(keys), reach)).otherwise(0)

    return F.when(F.size(words) < 3, 0).otherwise(_let(windows(words), of_windows))


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """The counts of the base rules, as long columns."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(_NOT_SPACE))
    symbols = F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": symbols,
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _covered(words),
    }
    return {name: column.cast("long") for name, column in found.items()}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, and words one blank apart."""
    blanks = F.trim(F.regexp_replace(F.lower(line), _SPACE, " "))
    return F.regexp_replace(blanks, "[0-9]+", "0")


def line_key(host: Column, line: Column) -> Column:
    """Key of a line of a host. A null host adds nothing and so has keys of its own."""
    return F.xxhash64(host, F.lit("|"), normalised(line))


def _line_words(host: Column, text: Column) -> Column:
    """Lines of a text with a word: (key, number of words)."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(_NOT_SPACE)
    )
    return F.transform(
        lines,
        lambda x: F.struct(
            line_key(host, x).alias("key"), F.size(words_of(x)).cast("long").alias("words")
        ),
    )


def _text_key(host: Column, text: Column) -> Column:
    """Copies of a text within a host are one document."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(host, F.lit("|"), F.length(whole), whole)


def _counted(documents: DataFrame, text: str, host: str, keep: list[str]) -> DataFrame:
    """The narrow row of every document."""
    source = documents.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{name}`").alias(name) for name in keep]).alias("row"),
        F.col(f"`{host}`").alias("host"),
        F.col(f"`{text}`").alias("text"),
        words_of(F.col(f"`{text}`")).alias("words"),
    )
    return stored(
        source.select(
            "row",
            F.xxhash64("host", F.lit("|")).alias("host_key"),
            _text_key(F.col("host"), F.col("text")).alias("text_key"),
            *[column.alias(name) for name, column in base_columns(F.col("text"), F.col("words")).items()],
            _line_words(F.col("host"), F.col("text")).alias("lines"),
        )
    )


def frequent_lines(counted: DataFrame, docs: int, percent: int) -> DataFrame:
    """Keys of the lines above both limits, with the distinct documents holding them."""
    hosts = counted.groupBy("host_key").agg(F.countDistinct("text_key").alias("host_docs"))
    lines = (
        counted.select("host_key", "text_key", F.explode("lines").alias("line"))
        .groupBy("host_key", F.col("line.key").alias("key"))
        .agg(F.countDistinct("text_key").alias("docs"))
        .where(F.col("docs") > docs)
    )
    return stored(
        lookup_join(lines, hosts, ["host_key"], "inner")
        .where(F.col("docs") * 100 > F.col("host_docs") * percent)
        .select("key", "docs", "host_docs")
    )


def _removed(counted: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per text with frequent lines: their keys and the words they hold."""
    held = counted.select("text_key", F.explode("lines").alias("line")).select(
        "text_key", F.col("line.key").alias("key"), F.col("line.words").alias("words")
    )
    # A text that comes in several rows gives each line as often; its rows count once.
    rows = counted.groupBy("text_key").agg(F.count("*").alias("rows"))
    lost = (
        lookup_join(held, frequent.select("key"), ["key"], "inner")
        .groupBy("text_key")
        .agg(F.sum("words").alias("words"), F.collect_set("key").alias("gone"))
    )
    return stored(
        lost.join(rows, "text_key").select(
            "text_key", "gone", (F.col("words") / F.col("rows")).cast("long").alias("words_gone")
        )
    )


def _depleted() -> Column:
    left = F.col("n_words") - F.coalesce(F.col("words_gone"), F.lit(0))
    return (left < MIN_WORDS) | (100 * left < MIN_LEFT_PERCENT * F.col("n_words"))


def _spared(
    counted: DataFrame, removed: DataFrame, frequent: DataFrame, docs: int, percent: int
) -> DataFrame:
    """``removed``, in which representatives of depleted near copies lose boilerplate only."""
    sizes = counted.where(~base_failed()).groupBy("text_key").agg(F.first("n_words").alias("n_words"))
    held = removed.join(sizes, "text_key").select(
        "text_key", _depleted().alias("depleted"), F.explode("gone").alias("key")
    )
    lines = held.groupBy("key").agg(
        (F.count(F.when(~F.col("depleted"), 1)) + 1).alias("classes"),
        F.min(F.when(F.col("depleted"), F.col("text_key"))).alias("holder"),
    )
    boilerplate = (F.col("classes") > docs) & (
        F.col("classes") * 100 > F.col("host_docs") * percent
    )
    content = stored(
        lookup_join(
            lines.where(F.col("holder").isNotNull()), frequent.select("key", "host_docs"), ["key"], "inner"
        )
        .where(~boilerplate)
        .select("key", "holder")
    )
    spared = stored(content.select(F.col("holder").alias("text_key")).distinct())
    theirs = stored(
        lookup_join(counted.select("text_key", "lines"), spared, ["text_key"], "inner")
    )
    lost = _removed(theirs, frequent.join(content, "key", "left_anti"))
    return stored(removed.join(spared, "text_key", "left_anti").unionByName(lost))


def _judged(counted: DataFrame, removed: DataFrame, keep: list[str]) -> DataFrame:
    left = F.col("n_words") - F.coalesce(F.col("words_gone"), F.lit(0))
    failed = base_failed()
    return lookup_join(counted, removed, ["text_key"], "left").select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~_depleted()).alias("kept"),
        left.alias("n_words_left"),
    )


def quality_rules(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    line_percent: int = LINE_PERCENT,
    representatives: bool = False,
) -> DataFrame:
    """Counts and verdict of every document.

    With ``representatives``, those of depleted near copies are judged as :func:`cleaned` does.
    """
    counted = _counted(documents, text, host, [id])
    frequent = frequent_lines(counted, line_docs, line_percent)
    removed = _removed(counted, frequent)
    if representatives:
        removed = _spared(counted, removed, frequent, line_docs, line_percent)
    return _judged(counted.drop("lines"), removed.drop("gone"), [f"row.{id}"])


def cleaned(
    documents: DataFrame,
    text: str = "text",
    host: str = "source",
    line_docs: int = LINE_DOCS,
    line_percent: int = LINE_PERCENT,
) -> DataFrame:
    """The documents that pass, their frequent lines removed; columns as before.

    Representatives of near copies that deplete each other pass and lose boilerplate only. The lines left stay as they were. Texts move only if the table of texts that go or lose lines is
    too large to broadcast.
    """
    columns = documents.columns
    counted = _counted(documents, text, host, [])
    frequent = frequent_lines(counted, line_docs, line_percent)
    removed = _removed(counted, frequent)
    removed = _spared(counted, removed, frequent, line_docs, line_percent)
    verdicts = _judged(counted.drop("lines"), removed, ["text_key", "gone"])
    # Texts that go or change; most do neither and are in no table.
    touched = stored(
        verdicts.where(~F.col("kept") | F.col("gone").isNotNull())
        .select("text_key", "gone", "kept")
        .dropDuplicates(["text_key"])
    )
    packed = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row"),
        F.col(f"`{host}`").alias("host"),
        _text_key(F.col(f"`{host}`"), F.col(f"`{text}`")).alias("text_key"),
    )
    lines = F.split(F.col("row")[text], "\n", -1)
    left = F.array_join(
        F.filter(
            lines,
            lambda x: ~x.rlike(_NOT_SPACE)
            | ~F.array_contains(F.col("gone"), line_key(F.col("host"), x)),
        ),
        "\n",
    )
    new_text = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(left)
    joined = lookup_join(packed, touched, ["text_key"], "left")
    return joined.where(F.coalesce("kept", F.lit(True))).select(
        *[new_text.alias(c) if c == text else F.col("row")[c].alias(c) for c in columns]
    )
