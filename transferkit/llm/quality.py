"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.llm.tables import where_computed
from transferkit.llm.words import places, text_of, tokens

SYMBOLS = r"[#*$%&|<>]"
# Common short words of the languages the rules are made for; a text of any length holds some of them.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by this are or an "
    "der die und das ist von mit den ein eine für im nicht zu des auf "
    "de la le les et un une est en que pour dans sur par avec pas "
    "el los las y es del se por con una para al lo como más"
).split()  # fixed values


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high``; a text whose ``whole`` is 0 passes."""

    name: str
    part: str
    whole: str
    low: float = 0.0
    high: float | None = None


MIN_WORDS = 50
REPEAT_PERCENT = 50
RULES = (
    Rule("mean word length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols to words", "n_symbols", "n_words", high=0.1),
    Rule("stop words", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate lines", "n_dup_lines", "n_lines", high=0.5),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``row``, the whole input row, beside the counts.

    Three-word windows are hashed with their place in the low bits, so one primitive sort brings equal windows
    together; neighbours are equal when their words are.
    """
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(text_col).alias("text"))
    d = d.select("row", "text", tokens(F.col("text")).alias("w"), F.split("text", "\n").alias("lines"))
    w, n = F.col("w"), F.size("w")
    d = d.select(
        "row", "text", "w", F.length(F.bin(n.cast("long"))).alias("bits"),
        F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    packed = F.transform(
        places(n, 3),
        lambda i: F.call_function(
            "shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), F.col("bits")
        ).bitwiseOR(i.cast("long")),
    )
    d = d.select("*", F.sort_array(packed).alias("s"))
    s = F.col("s")

    def window(x: Column) -> Column:
        """The hash of a packed window."""
        return F.call_function("shiftright", x, F.col("bits"))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")

    def same(x: Column, y: Column) -> Column:
        return (window(x) == window(y)) & F.slice(w, place(x) + 1, F.lit(3)).eqNullSafe(
            F.slice(w, place(y) + 1, F.lit(3))
        )

    def beside(x: Column, j: Column) -> Column:
        return F.coalesce(same(x, F.get(s, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, j + 1)), F.lit(False))

    twice = F.filter(s, beside)
    # a filter on the counts is not pushed below a column that depends on a row's place, so that no lambda
    # has an array's whole expression written out in it
    d = d.select("*", F.transform(twice, place).alias("twice"), F.monotonically_increasing_id().alias("at"))
    covered = F.array_distinct(F.flatten(F.transform("twice", lambda p: F.array(p, p + 1, p + 2))))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.when(F.col("at") >= 0, F.size(covered)),
        "n_lines": F.size("lines"),
        "n_stop_words": F.size(F.filter(w, lambda v: F.lower(v).isin(STOP_WORDS))),
    }
    return d.select("row", *[counts[c].cast("long").alias(c) for c in COUNTS])


def failed() -> Column:
    """Too short, or mostly windows that repeat."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of rules as one condition over the counts."""
    passed = ~failed()
    for r in rules:
        part, whole = F.col(r.part).cast("double"), F.col(r.whole).cast("double")
        passed &= part >= r.low * whole
        if r.high is not None:
            passed &= part <= r.high * whole
    return passed


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Counts and verdict of every document, one row for each input row.

    Null and empty texts have no words and fail.  A verdict rests on one text only, so repeated rows agree and
    there are no ties; other columns are not read, and an empty table gives an empty result.
    """
    d = _measured(docs, text_col)
    return d.select(
        F.col("row")[id_col].alias(id_col), *COUNTS, failed().alias("base_failed"), verdict(rules).alias("kept")
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass every rule, with the columns they came with."""
    return where_computed(_measured(docs, text_col), verdict(rules)).select("row.*")
