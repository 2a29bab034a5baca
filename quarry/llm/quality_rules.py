"""Quality rules: a table of thresholds compiled into Spark projections of
length, symbol, stop-word and line ratios.  No user function and no shuffle:
one stage of built-in expressions over the scan.

Defined cases: a null or empty text has no words, so it fails the base check;
rows are judged one by one, so repeated rows repeat and an empty table gives an
empty result; a bound is inclusive; extra columns pass through ``judge``
untouched unless they have the name of a result column, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, SPACE_CHARS

# Function words of the four languages
STOP_WORDS = tuple(dict.fromkeys((
    "a an and are as at be but by for from have he in is it not of on or that the they this to was "
    "which with you "
    "au aux ce dans de des du elle en est et il la le les ne ou par pas pour que qui se son sur un une "
    "auf aus bei das dem den der die ein eine es für im ist mit nicht sich sie und von zu "
    "al como con del el ella las lo los más no para por su sus y").split()))
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
EDGE_MARKS = ".,;:!?\"'()[]"


@dataclass(frozen=True)
class Rule:
    """A text passes if ``least <= metric <= most``; None: no bound."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "mean_word_length", 3.0, 10.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("alphabetic", "alpha_ratio", least=0.8),
    Rule("upper_case", "upper_ratio", most=0.3),
    Rule("stop_words", "n_stop", least=2),
    Rule("stop_word_share", "stop_ratio", least=0.05),
    Rule("repeated_lines", "dup_line_ratio", most=0.3),
    Rule("ellipsis_lines", "ellipsis_ratio", most=0.3),
    Rule("bullet_lines", "bullet_ratio", most=0.9),
)

# For a corpus that is to keep its clean short texts: ten words with one function word and a number
# or two pass (the share of stop words still has its bound)
CORPUS_RULES = tuple(replace(r, least=0.6) if r.name == "alphabetic" else r for r in RULES if r.name != "stop_words")

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5


def compile_rules(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The table as two expressions: the verdict, and the names of the rules
    that a row breaks."""
    broken = []
    for r in rules:
        m, bad = F.col(f"_m.{r.metric}"), F.lit(False)
        if r.least is not None:
            bad = bad | (m < F.lit(r.least))
        if r.most is not None:
            bad = bad | (m > F.lit(r.most))
        broken.append(F.when(bad, F.lit(r.name)))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return F.size(names) == 0, names


def _repeated_words(text_windows: Column) -> tuple[Column, Column]:
    """Words that a window found twice covers.  All 64-bit window hashes
    different proves that no window repeats; only then else the windows
    themselves are sorted and compared, so a hash collision changes nothing."""
    order = F.sort_array(F.transform(text_windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    twice = F.filter(F.transform(F.col("_sorted"), lambda x, i: F.when(
        ((i > 0) & (F.get(F.col("_sorted"), i - 1)["w"] == x["w"]))
        | (F.get(F.col("_sorted"), i + 1)["w"] == x["w"]), x["i"])), lambda p: p.isNotNull())
    return order, F.sort_array(twice)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (long) and ``_m``, the metrics of the rules."""
    own = [c for c in df.columns if c.lower() not in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_m", "_t", "_words",
        "_lines", "_hashes", "_sorted", "_twice")]
    keep = [F.col(f"`{c}`") for c in own]
    blank = F.lit(SPACE_CHARS)
    t = df.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    body = F.btrim(F.col("_t"), blank)
    t = t.select(
        *keep, "_t",
        F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE)).alias("_words"),
        F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, blank) != "").alias("_lines"))
    w, n = F.col("_words"), F.size("_words")
    tail = lambda i: [F.get(w, i + k) for k in range(1, WINDOW)]
    starts = F.slice(w, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    t = t.select(*keep, "_t", "_words", "_lines",
                 F.transform(starts, lambda x, i: F.xxhash64(x, *tail(i))).alias("_hashes"))
    order, twice = _repeated_words(
        F.transform(starts, lambda x, i: F.concat_ws(" ", x, *tail(i))))
    none = F.array().cast("array<struct<w:string,i:int>>")
    t = t.select(*keep, "_t", "_words", "_lines", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"), order).otherwise(none).alias("_sorted"))
    t = t.select(*keep, "_t", "_words", "_lines", F.when(
        F.size("_sorted") > 0, twice).otherwise(F.array().cast("array<int>")).alias("_twice"))
    p = F.col("_twice")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    some = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    t = t.select(
        *keep, "_t", "_words", "_lines", n.cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        some(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"))
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    per_line = F.greatest(F.size("_lines"), F.lit(1))
    count = lambda a, f: F.size(F.filter(a, f))
    t = t.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_words", "_lines",
        some(UPPER).alias("_upper"),
        count("_words", lambda x: F.lower(F.btrim(x, F.lit(EDGE_MARKS))).isin(*STOP_WORDS)).alias("_stop"))
    return t.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.struct(
            (F.col("word_chars") / per_word).alias("mean_word_length"),
            (F.col("n_symbols") / per_word).alias("symbol_ratio"),
            (count("_words", lambda x: x.rlike(r"\p{L}")) / per_word).alias("alpha_ratio"),
            (F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("upper_ratio"),
            F.col("_stop").alias("n_stop"),
            (F.col("_stop") / per_word).alias("stop_ratio"),
            (F.col("n_dup_lines") / per_line).alias("dup_line_ratio"),
            (count("_lines", lambda x: x.rlike(r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*$")) / per_line)
            .alias("ellipsis_ratio"),
            (count("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*\x{2022}]")) / per_line)
            .alias("bullet_ratio")).alias("_m"))


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with the measures, ``base_failed``, ``broken_rules`` (names) and
    ``kept``."""
    t = measure(df.drop("base_failed", "broken_rules", "kept"), text)
    passed, broken = compile_rules(rules)
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # as the one entry of an exploded array, so that a later filter on a result stays above the
    # projections: pushed below, it would compute the words anew for each word
    t = t.select(*[f"`{c}`" for c in t.columns if c not in (*made, "_m")], F.explode(F.array(F.struct(
        *made, base.alias("base_failed"), broken.alias("broken_rules"), (~base & passed).alias("kept")))).alias("_j"))
    return t.select(*[f"`{c}`" for c in t.columns if c != "_j"], "_j.*")
