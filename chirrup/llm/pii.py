"""Personal data by fixed forms, and by contexts that those forms teach.

Base matches are the seeds. The two words before a seed, or those from the text's start, make a pattern; the identifiers that patterns extract and the
patterns that extract them form a graph, which Spark scores in rounds: a pattern by the share of its distinct
identifiers that are known to be of one kind, an identifier by its best pattern. High scores make new known identifiers,
which score the patterns of the next round, until a round finds no new pattern.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")

# The base forms. Possessive repeats and look-behinds find the same matches without backtracking, so that
# long runs of one class cost no more than their length.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# What a pattern may extract: a word with a digit or an @, without the punctuation around it.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# Or a run of number words, instead of the words in it.
NUMBER = r"[+(]*+[0-9][0-9().+/-]*+(?![^\x20\x09-\x0D,;:!?\]}>\"'])"
RUN = rf"(?<![^\x20\x09-\x0D]){NUMBER}(?:\x20{NUMBER})++"

# So many code points before a match are its context, or more; of a longer word in it, the last WORD_END count.
CONTEXT = 100
WORD_END = 40

# A pattern counts from so many known identifiers and such a share (in thousandths) of all that it extracts.
MIN_KNOWN = 3
MIN_SCORE = 800

# Shorter words are no identifiers.
MIN_CANDIDATE = 5


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda total, value: total + F.coalesce(value, F.lit(0))) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    return (
        F.when(kind == "ip", match.rlike(rf"^{BYTE}(\.{BYTE}){{3}}$"))
        .when(kind == "card", F.when(count.between(14, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", count.between(10, 15))
        .otherwise(True)
    )


def _matches(body: Column, kind: str, form: str, may: Column) -> Column:
    """Each match with its length before it since the last match, and the end of what is between them."""
    found, between = F.regexp_extract_all(body, F.lit(form), F.lit(0)), F.split(body, form, -1)
    pairs = F.zip_with(found, between, lambda match, gap: F.when(match.isNotNull(), F.struct(
        F.lit(kind).alias("kind"), match.alias("match"), F.char_length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT)).alias("left"),
    )))
    empty = F.array().cast("array<struct<kind:string,match:string,gap:int,left:string>>")
    return F.when(may, F.array_compact(pairs)).otherwise(empty)


def occurrences(docs: DataFrame, text: str, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with their place `_row`, stored, and their matches `_row, kind, match, start, end, context`.

    The kind of a candidate is `?`, of a run of numbers `#`. Candidates are whole words, so the two before one hold its last two words, if those
    are not in the text between them; every base match begins in a candidate.
    """
    body = text_or_empty(text)
    digit = body.rlike("[0-9]")
    may = {"email": F.contains(body, F.lit("@")), "ip": digit, "card": digit, "phone": digit & F.contains(body, F.lit("+"))}
    lists = [_matches(body, kind, FORMS[kind], may[kind]) for kind in KINDS]
    lists += [_matches(body, "?", CANDIDATE, digit | may["email"]), _matches(body, "#", RUN, digit)]
    rows = docs.select(*(F.col(f"`{x}`").alias(f"_own_{k}") for k, x in enumerate(carry)), F.concat(*lists).alias("_found"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    each = rows.filter(F.size("_found") > 0).select("_row", F.posexplode("_found").alias("place", "m")).select("_row", "place", "m.*").repartition("_row")
    of_kind = Window.partitionBy("_row", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.char_length("match")).over(of_kind.rowsBetween(Window.unboundedPreceding, 0))
    tail = F.right(F.concat("left", "match"), F.lit(CONTEXT))
    each = each.select("*", end.cast("long").alias("end"), *(F.coalesce(F.lag(tail, k).over(of_kind), F.lit("")).alias(f"tail_{k}") for k in (1, 2)))
    joined = lambda before, after: F.when(F.char_length(after) < CONTEXT, F.concat(before, after)).otherwise(after)
    each = each.withColumn("start", F.col("end") - F.char_length("match")).withColumn("before", joined(joined(F.col("tail_2"), F.col("tail_1")), F.col("left")))
    held = F.when(F.col("kind") == "?", F.struct("start", "match", "before"))
    word = F.last(held, ignorenulls=True).over(Window.partitionBy("_row").orderBy("start", F.col("kind") != "?").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("word", word)
    inside = F.left(F.col("word.match"), (F.col("start") - F.col("word.start")).cast("int"))
    return rows.drop("_found"), each.select("_row", "kind", "match", "start", "end", F.concat("word.before", inside).alias("context"))


def _pattern(context: Column, start: Column) -> Column:
    """The last two words, in lower case, with 0 for a digit and @ for a word that holds one; ^ stands for the text's start."""
    plain = F.translate(F.lower(context), "\t\n\x0b\x0c\r0123456789", "     0000000000")
    words = F.array_remove(F.split(plain, " "), "")
    last = F.when(F.size(words) > 2, F.slice(words, -2, 2)).otherwise(words)
    ends = F.transform(last, lambda word: F.when(F.contains(word, F.lit("@")), "@").otherwise(F.right(word, F.lit(WORD_END))))
    first = F.when((F.size(words) < 2) & (F.char_length(context) == start), F.array(F.lit("^"))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(first, ends), " ")


def _trimmed(candidates: DataFrame) -> DataFrame:
    """Without punctuation at the ends."""
    lead = F.char_length("match") - F.char_length(F.ltrim("match", F.lit("([{<\"'")))
    bare = F.rtrim(F.ltrim("match", F.lit("([{<\"'")), F.lit(".,;:!?)]}>\"'"))
    trimmed = candidates.withColumn("context", F.concat("context", F.left("match", lead))).withColumn("start", F.col("start") + lead).withColumn("match", bare).withColumn("end", F.col("start") + F.char_length("match"))
    return trimmed.filter(F.char_length("match") >= MIN_CANDIDATE)


def discovered(base: DataFrame, candidates: DataFrame, rounds: int | None = None) -> DataFrame:
    """Candidates that confident patterns extract and that overlap no base match: `_row, kind, start, end`."""
    spans = base.select("_row", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    overlap = (F.col("c._row") == F.col("b._row")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end"))
    pattern = _pattern(F.col("context"), F.col("start")).alias("pattern")
    free = candidates.alias("c").join(spans.alias("b"), overlap, "left_anti").select("_row", "kind", "match", "start", "end", pattern)
    runs = free.filter("kind = '#'").select("_row", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    part = (F.col("kind") == "?") & (F.col("w._row") == F.col("r._row")) & (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    free = stored(free.alias("w").join(runs.alias("r"), part, "left_anti").drop("kind"))
    value = F.xxhash64(F.lower("match"))
    edges = stored(
        base.select(pattern, value.alias("value"), "kind")
        .unionByName(free.select("pattern", value.alias("value"), F.lit(None).cast("string").alias("kind")))
        .groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    )
    counts = [F.count_if(F.col("kind") == kind).alias(kind) for kind in KINDS]
    known, patterns, n_patterns, done = edges, None, 0, 0
    while rounds is None or done < rounds:
        scored = known.groupBy("pattern").agg(F.count("*").alias("all"), *counts)
        best = F.greatest(*(F.struct(F.col(kind).alias("n"), F.lit(kind).alias("kind")) for kind in KINDS))
        confident = (
            scored.withColumn("best", best)
            .filter((F.col("best.n") >= MIN_KNOWN) & (1000 * F.col("best.n") >= MIN_SCORE * F.col("all")))
            .select("pattern", F.col("best.kind").alias("p_kind"))
        )
        if patterns is not None:  # a confident pattern stays
            confident = patterns.unionByName(confident.join(patterns.select("pattern"), "pattern", "left_anti"))
        patterns, before, done = stored(confident), n_patterns, done + 1
        n_patterns = patterns.count()
        if n_patterns == before:
            break
        found = edges.filter(F.col("kind").isNull()).join(patterns, "pattern").groupBy("value").agg(F.max("p_kind").alias("p_kind"))
        known = edges.join(found, "value", "left").select("pattern", "value", F.coalesce("kind", "p_kind").alias("kind"))
    if patterns is None:
        return free.limit(0).select("_row", F.lit("").alias("kind"), "start", "end")
    return free.join(patterns, "pattern").select("_row", F.col("p_kind").alias("kind"), "start", "end")


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None, rounds: int | None = None) -> DataFrame:
    """Add `spans`: `(start, rank, end, kind, base)` of all personal data, by start, then kind; code points, end exclusive.

    Base matches are those of `FORMS` that pass their checks; learned ones have `base` false and do not overlap them.
    A null or empty text has no spans; repeated rows are searched each, and count once as teachers; an empty table
    stays empty; a column `spans` is replaced. `rounds` bounds the rounds (none by default). `carry` names the columns to keep (all by default).
    """
    names = [x for x in (docs.columns if carry is None else carry) if x != "spans"]
    rows, each = occurrences(docs, text, names)
    each = stored(each)
    base = each.filter(F.col("kind").isin(*KINDS) & _valid(F.col("kind"), F.col("match")))
    learned = discovered(base, _trimmed(each.filter(~F.col("kind").isin(*KINDS))), rounds)
    columns = ["_row", "kind", "start", "end"]
    found = base.select(*columns, F.lit(True).alias("base")).unionByName(learned.select(*columns, F.lit(False).alias("base")))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(F.col("start").cast("long").alias("start"), rank.alias("rank"), F.col("end").cast("long").alias("end"), "kind", "base")
    lists = found.distinct().groupBy("_row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(lists.schema["spans"].dataType)
    joined = rows.join(lists, "_row", "left")
    return joined.select(*(F.col(f"_own_{k}").alias(name) for k, name in enumerate(names)), F.coalesce("spans", empty).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first in angle brackets."""
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"), F.element_at(done, -1)["kind"].alias("kind"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    state = F.aggregate(
        merged,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.struct(
            F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")), F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"),
            s["end"].alias("at"),
        ),
    )
    rest = F.concat(state["out"], F.substring(text, state["at"].cast("int") + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(rest)


def joined_spans(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
