"""Quality rules whose thresholds adapt to each language and source.

Each measure of a text is a whole number from a bounded range, so a count for each value is a quantile sketch that
merges by addition: Spark combines it before the shuffle, whatever the size of a group. Thresholds are quantiles of the
sketches and join back to the texts' measures.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored, text_or_empty

# Fixed values of the base rules.
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
WHITE = " \t\n\x0b\x0c\r"

# A measure is rejected above the upper quartile of its group plus FENCE spreads. The spread is the distance of the
# quartiles, but not less than what one event adds to the group's median text, or to the text itself if that is shorter:
# so many characters, lines, words (a 3-word window that occurs twice) or letters. Shares are in thousandths of the
# characters, lines or words; word lengths in tenths of a character. No limit has a constant minimum.
RULES = {"symbols": 1, "marks": 1, "dup_lines": 1, "repeats": 6, "word_length": 1}
FENCE = 4

# The sketch of a group is merged with its language's, condensed to so many quantiles of so many texts each; so few texts
# say little, and no size of a group is a bound.
POINTS, POINT_TEXTS = 20, 5
TOP = 1000

# Up to so many distinct repeated windows are looked up one by one; beyond it, windows are sorted. Both are exact.
FEW_REPEATS = 32


def _share(part: Column, whole: Column, scale: int) -> Column:
    return F.least(F.lit(TOP), F.floor(F.lit(scale) * part / F.greatest(whole, F.lit(1)))).cast("int")


def _step(events: int, whole: Column, scale: int) -> Column:
    """What so many events add to a share of the whole, rounded up."""
    return F.least(F.lit(TOP), F.ceil(F.lit(scale * events) / F.greatest(whole, F.lit(1)))).cast("int")


def _covered(starts: Column) -> Column:
    """Words in the 3-word windows that begin at the ascending `starts`."""
    steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(3)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + F.coalesce(step, F.lit(3)))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `_rule_...` columns: n_words, word_chars, n_symbols, n_marks, n_lines, n_dup_lines, n_repeat_words."""
    c = lambda name: F.col(f"_rule_{name}")
    body = text_or_empty(text)
    plain = F.translate(body, WHITE[1:], " " * (len(WHITE) - 1))
    df = docs.withColumn("_rule_words", F.array_remove(F.split(plain, " "), ""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, WHITE, "") != "")
    df = df.withColumn("_rule_line_list", lines).withColumn("_rule_n_words", F.size("_rule_words"))
    size = c("n_words") - 2
    pairs = F.zip_with(F.slice("_rule_words", F.lit(1), size), F.slice("_rule_words", F.lit(2), size), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice("_rule_words", F.lit(3), size), lambda h, word: F.xxhash64(h, word))
    df = df.withColumn("_rule_windows", F.when(size > 0, windows).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_rule_sorted", F.sort_array("_rule_windows"))
    n = F.size("_rule_sorted")
    same = F.zip_with("_rule_sorted", F.slice("_rule_sorted", F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.when(a == b, a))
    df = df.withColumn("_rule_same", F.array_distinct(F.array_compact(same)))
    few = F.array_compact(F.transform("_rule_windows", lambda h, i: F.when(F.array_contains(c("same"), h), i)))
    placed = F.sort_array(F.transform("_rule_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ahead = F.concat(F.slice(placed, F.lit(2), F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    behind = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(placed, F.lit(1), F.greatest(n - 1, F.lit(0))))
    with_next = F.zip_with(placed, ahead, lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("next")))
    many = F.sort_array(F.array_compact(F.zip_with(with_next, behind, lambda a, b: F.when(a["next"] | F.coalesce(a["h"] == b["h"], F.lit(False)), a["i"]))))
    starts = F.when(F.size("_rule_same") == 0, F.array().cast("array<int>")).when(F.size("_rule_same") <= FEW_REPEATS, few).otherwise(many)
    df = df.withColumn("_rule_starts", starts)
    without = lambda characters: F.char_length(F.translate(body, characters, ""))
    return df.select(
        *(F.col(f"`{name}`") for name in docs.columns),
        c("n_words").cast("long").alias("_rule_n_words"),
        without(WHITE).cast("long").alias("_rule_word_chars"),
        (F.char_length(body) - without(SYMBOLS)).cast("long").alias("_rule_n_symbols"),
        (F.char_length(body) - without(MARKS)).cast("long").alias("_rule_n_marks"),
        F.size("_rule_line_list").cast("long").alias("_rule_n_lines"),
        (F.size("_rule_line_list") - F.size(F.array_distinct("_rule_line_list"))).cast("long").alias("_rule_n_dup_lines"),
        F.when(F.size("_rule_starts") > 0, _covered(c("starts"))).otherwise(0).cast("long").alias("_rule_n_repeat_words"),
    )


def thresholds(measures: DataFrame) -> DataFrame:
    """For each language, source and rule the upper quartile `_high_...` and the `_spread_...` of the merged sketches."""
    names = [f"_{part}_{rule}" for rule in RULES for part in ("bin", "step")]
    marks = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).alias("bin")) for name in names)))
    own = measures.select("_lang", "_source", marks.alias("m")).groupBy("_lang", "_source", "m.name", "m.bin").agg(F.count("*").alias("n"))
    upto = lambda df, *keys: df.select("*", F.sum("n").over(Window.partitionBy(*keys)).alias("texts"), F.sum("n").over(Window.partitionBy(*keys).orderBy("bin")).alias("upto"))
    language = upto(own.groupBy("_lang", "name", "bin").agg(F.sum("n").alias("n")), "_lang", "name")
    # Point i stands at (2 i - 1) / (2 POINTS) of the texts.
    points = F.expr(f"(upto * {2 * POINTS} + texts) div (2 * texts) - ((upto - n) * {2 * POINTS} + texts) div (2 * texts)")
    language = language.select(F.col("_lang").alias("_of"), "name", "bin", (points * POINT_TEXTS).alias("n")).filter("n > 0")
    groups = own.select("_lang", "_source").distinct()
    merged = own.unionByName(groups.join(language, F.col("_lang").eqNullSafe(F.col("_of"))).select(own.columns))
    ranked = upto(merged, "_lang", "_source", "name")
    quantile = lambda name, q: F.min(F.when((F.col("name") == name) & (F.col("upto") * 100 >= F.col("texts") * q), F.col("bin")))
    found = {f"_high_{rule}": quantile(f"_bin_{rule}", 75) for rule in RULES}
    found |= {f"_spread_{rule}": F.greatest(quantile(f"_bin_{rule}", 75) - quantile(f"_bin_{rule}", 25), quantile(f"_step_{rule}", 50)) for rule in RULES}
    return ranked.groupBy("_lang", "_source").agg(*(value.alias(name) for name, value in found.items()))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """Add the counts of the base rules, `base_failed` and `kept` (false if a base rule or an adaptive threshold fails).

    Thresholds come from all texts that pass the base rules, by language and source, whose sketch is merged with a
    condensed one of the language. A null text is empty and fails; null languages and sources are groups of their own;
    repeated rows count and are judged each; an empty table stays empty; columns with the names of the results are
    replaced. `carry` names the columns to keep (all by default).
    """
    names = docs.columns if carry is None else carry
    rows = docs.select(*(F.col(f"`{x}`").alias(f"_own_{k}") for k, x in enumerate(names)), F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.col(source).alias("_source"))
    r = lambda name: F.col(f"_rule_{name}")
    rows = measured(rows, "_text").drop("_text")
    failed = (r("n_words") < MIN_WORDS) | (100 * r("n_repeat_words") > 50 * r("n_words"))
    bins = {
        "symbols": _share(r("n_symbols"), r("word_chars"), 1000), "marks": _share(r("n_marks"), r("word_chars"), 1000),
        "dup_lines": _share(r("n_dup_lines"), r("n_lines"), 1000), "repeats": _share(r("n_repeat_words"), r("n_words"), 1000),
        "word_length": _share(r("word_chars"), r("n_words"), 10),
    }
    wholes = {"symbols": ("word_chars", 1000), "marks": ("word_chars", 1000), "dup_lines": ("n_lines", 1000), "repeats": ("n_words", 1000), "word_length": ("n_words", 10)}
    steps = {f"_step_{rule}": _step(RULES[rule], r(whole), scale) for rule, (whole, scale) in wholes.items()}
    rows = stored(rows.withColumns({"_failed": failed} | {f"_bin_{rule}": value for rule, value in bins.items()} | steps))
    limits = thresholds(rows.filter(~F.col("_failed")))
    limits = limits.withColumnsRenamed({"_lang": "_of_lang", "_source": "_of_source"})
    match = F.col("_lang").eqNullSafe(F.col("_of_lang")) & F.col("_source").eqNullSafe(F.col("_of_source"))
    rows, within = rows.join(limits, match, "left"), F.lit(True)
    for rule in RULES:
        within &= F.col(f"_bin_{rule}") <= F.col(f"_high_{rule}") + FENCE * F.greatest(F.col(f"_spread_{rule}"), F.col(f"_step_{rule}"))
    results = {"n_words": r("n_words"), "word_chars": r("word_chars"), "n_symbols": r("n_symbols"), "n_dup_lines": r("n_dup_lines"),
               "n_repeat_words": r("n_repeat_words"), "base_failed": F.col("_failed"), "kept": ~F.col("_failed") & F.coalesce(within, F.lit(False))}
    own = [F.col(f"_own_{k}").alias(name) for k, name in enumerate(names) if name not in results]
    return rows.select(*own, *(value.alias(name) for name, value in results.items()))
