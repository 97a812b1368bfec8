"""Quality rules as one projection: a threshold table over length, symbol,
stop-word and line ratios, compiled to column expressions.  No user functions:
every count is a SQL expression over the text, its words array and its sorted
three-word windows, inside one row; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Frequent words of the languages served.
STOP_WORDS = ("the of and to a in is that it for was on with as be by are this at from "
              "der die und den von das zu mit sich des für auf ist nicht im dem ein eine als "
              "de la le et les en un du une que pour est par qui dans sur pas avec au "
              "el y los del se las por con su no para es al lo").split()


@dataclass(frozen=True)
class Rule:
    """``low <= value / per <= high``; without ``per`` the value itself.  A
    missing bound is open; a ratio to nothing is null and passes."""
    name: str
    value: str
    per: str | None = None
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        v = F.expr(self.value) if self.per is None else F.try_divide(F.expr(self.value), F.expr(self.per))
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | (v < F.lit(self.low))
        if self.high is not None:
            bad = bad | (v > F.lit(self.high))
        return F.coalesce(bad, F.lit(False))


BASE = (
    Rule("too_short", "n_words", low=50),
    Rule("repeats", "100 * n_repeat_words - 50 * n_words", high=0),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.2),
    Rule("capitals", "n_capitals", "word_chars", high=0.4),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
)


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every text (null: none), one row per input row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(docs[id_col].alias("doc_id"), text.alias("t"))
    words = F.filter(F.split("t", "[ \t\n\u000b\f\r]+"), lambda x: x != "")
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SEPARATORS, "") != "")
    # each step is a projection of its own: arrays are built once, then referred to
    step = base.select("doc_id", "t", words.alias("w"), lines.alias("l"))
    window = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.struct(F.concat_ws(" ", x, F.get("w", i + 1), F.get("w", i + 2)).alias("g"), i.alias("i")))
    step = step.select("*", F.sort_array(window).alias("s"))
    same = F.filter("s", lambda x, j: F.coalesce(F.get("s", j - 1)["g"] == x["g"], F.lit(False))
                    | F.coalesce(F.get("s", j + 1)["g"] == x["g"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return step.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SEPARATORS, "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).alias("n_symbols"),
        _count(F.col("t"), CAPITALS).alias("n_capitals"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("l", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long")
        .alias("n_ellipsis_lines"),
        F.size(F.filter("l", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))).cast("long")
        .alias("n_bullet_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and the names of the rules that fail.

    One row per input row, also for null ids.  Null, empty and blank texts have
    no words and fail the base; ratios of nothing are null and pass.  Repeated
    rows are judged each.  Empty table: empty result.  Extra columns are not read.
    """
    m = measures(docs, id_col, text_col)

    def any_of(rs):
        out = F.lit(False)
        for r in rs:
            out = out | r.failed()
        return out

    failed = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in (*base, *rules)]))
    return m.select("*", any_of(base).alias("base_failed"), (~any_of((*base, *rules))).alias("kept"),
                    failed.alias("failed_rules"))
