"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card numbers and phone numbers, kind by kind, leftmost and without
overlap. They seed a graph of instances and patterns. An instance's patterns are the word to the left, the word to the
right, both, the two words to the left, its shape (digits as 9, capitals as A, other letters as a), and the word to the
left with the shape. Round by round, Spark scores a pattern for a kind by its distinct instances: those known to be of
the kind count for it, those of other kinds and unknown ones against it; for a shape, unknown ones only half, since the
base patterns are strict (a card number with a wrong digit is unknown). Identifier-like tokens (with a digit or an @, at most LONGEST
characters) in a confident pattern become known instances, with its confidence as their weight; so confident patterns
discover identifiers that the base patterns miss. Base spans always stay; a discovered span never overlaps one.

Positions come from splitting a text at its matches and summing up the lengths of the pieces; the sums run in blocks,
so that a text with many matches costs little more than its length. Frequent patterns and values are counted before
they are shuffled, and meet few rows by broadcast.

Defined cases: null and empty texts have no spans; base spans of several kinds may overlap, and all of them stay, by
start and then kind; a token in confident patterns of several kinds takes the most confident one, the last by name at
ties; very long texts are searched whole; repeated rows get equal results; rows with a null doc_id are handled like
others; an empty table gives an empty result; only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import matched, meet, saved, table

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns. Possessive repeats, and starts that never lie within a run unless a match ended there, find the same matches without backtracking or recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"(?:\G|(?<![^\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+",
}
#: A text without such a character has no match.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+", "token": ""}
ROUNDS = 3
#: A pattern counts from this score (of words beside an instance, of its shape) and this number of distinct known instances on.
CONFIDENT, CONFIDENT_SHAPE, SUPPORT = 0.75, 0.6, 5
#: Longer tokens are no identifiers of these kinds.
LONGEST = 64
BLOCK = 128
_L = "cast(0 as bigint)"


def _running(lengths: str) -> str:
    """SQL: for each element of an array of bigints, the sum of those before it."""
    inner = lambda array, start: f"aggregate({array}, named_struct('at', {start}, 'out', cast(array() as array<bigint>)), (s, x) -> named_struct('at', s.at + x, 'out', concat(s.out, array(s.at))), s -> s.out)"
    blocks = f"transform(sequence(0, greatest(0, (size({lengths}) - 1) div {BLOCK})), j -> slice({lengths}, cast(j as int) * {BLOCK} + 1, {BLOCK}))"
    sums = f"transform({blocks}, b -> aggregate(b, {_L}, (s, x) -> s + x))"
    return f"flatten(zip_with({blocks}, {inner(sums, _L)}, (b, t) -> {inner('b', 't')}))"


def _pieces(kind: str) -> tuple[Column, Column]:
    """The matches of a kind, and what stands between them."""
    text, pattern = F.col("text"), F.lit(PATTERNS[kind])
    there = F.col("_digits") if kind not in ("email", "token") else (F.contains(text, F.lit("@")) if kind == "email" else F.col("_digits") | F.contains(text, F.lit("@")))
    if NEEDS[kind] and kind != "email":
        there = there & F.contains(text, F.lit(NEEDS[kind]))
    none = F.array().cast("array<string>")
    return F.when(there, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none), F.when(there, F.split(text, PATTERNS[kind], -1)).otherwise(none)


_DIGITS = "regexp_replace({0}, '[^0-9]', '')"
_LUHN = f"aggregate(sequence(1, length({_DIGITS})), cast(0 as bigint), (u, i) -> u + (cast(substr({_DIGITS}, i, 1) as int) * (1 + (length({_DIGITS}) - i) % 2)) div 10 + (cast(substr({_DIGITS}, i, 1) as int) * (1 + (length({_DIGITS}) - i) % 2)) % 10) % 10 = 0"
_VALID = {
    "email": "true",
    "ip": "forall(split({0}, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', substr(ltrim('0', p), 1, 3)) as int) <= 255)",
    "card": f"case when length({_DIGITS}) between 12 and 19 then {_LUHN} else false end",
    "phone": f"length({_DIGITS}) between 9 and 15",
    "token": "true",
}
_SPACE = r"[\\x20\\x09-\\x0D]"
_WORD = r"[^\\x20\\x09-\\x0D]"


def _spans(kind: str) -> str:
    """SQL: the valid matches of a kind with positions and neighbouring words."""
    m, g = f"m_{kind}", f"g_{kind}"
    lengths = f"zip_with({m}, slice({g}, 1, size({m})), (x, y) -> cast(length(x) + length(y) as bigint))"
    left = f"coalesce(nullif(regexp_extract(right({g}[i], 100), '({_WORD}{{1,40}}){_SPACE}*$', 1), ''), if(i > 0, {m}[i - 1], ''))"
    before = f"regexp_extract(right({g}[i], 100), '({_WORD}{{1,40}}){_SPACE}+{_WORD}{{1,40}}{_SPACE}*$', 1)"
    right = f"coalesce(nullif(regexp_extract(left({g}[i + 1], 100), '^{_SPACE}*({_WORD}{{1,40}})', 1), ''), if(i + 1 < size({m}), {m}[i + 1], ''))"
    one = f"named_struct('start', r[i] + length({g}[i]), 'end', r[i] + length({g}[i]) + length({m}[i]), 'value', {m}[i], 'before', lower({before}), 'left', lower({left}), 'right', lower({right}))"
    made = f"transform(array({_running(lengths)}), r -> transform(sequence(0, size({m}) - 1), i -> {one}))[0]"
    return f"case when size({m}) > 0 then filter({made}, s -> {_VALID[kind].replace('{0}', 's.value')}) else cast(array() as array<struct<start:bigint,end:bigint,value:string,before:string,left:string,right:string>>) end"


def _trimmed(tokens: str) -> str:
    """SQL: tokens without the marks around them, those that are short enough."""
    lead = r"length(regexp_extract(t.value, '^[^\\p{L}\\p{N}+]*', 0))"
    core = rf"regexp_replace(substr(t.value, {lead} + 1), '(?<=[\\p{{L}}\\p{{N}})])[^\\p{{L}}\\p{{N}})]++$', '')"
    one = f"named_struct('start', t.start + {lead}, 'end', t.start + {lead} + length({core}), 'value', {core}, 'before', t.before, 'left', t.left, 'right', t.right)"
    return f"filter(transform({tokens}, t -> {one}), t -> length(t.value) between 1 and {LONGEST})"


#: What tells a row: two hashes of its id and text. Rows that share them are repeats, and get equal spans.
KEYS = ["key_a", "key_b"]


def base(docs: DataFrame) -> DataFrame:
    """doc_id, the row's keys, and the base spans of each kind as well as the identifier-like tokens, from the whole text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("key_a"), F.xxhash64("text", F.lit(1), "doc_id").alias("key_b"), "text", F.rlike("text", F.lit("[0-9]")).alias("_digits"))
    cut = rows
    for kind in PATTERNS:
        matches, gaps = _pieces(kind)
        cut = cut.withColumns({f"m_{kind}": matches, f"g_{kind}": gaps})
    spans = {k: F.expr(_spans(k)) for k in PATTERNS}
    found = cut.select("doc_id", *KEYS, *[c.alias(k) for k, c in spans.items()])
    return saved(found.withColumn("token", F.expr(_trimmed("token"))), "base-spans")


def _over(a: str, b: str) -> str:
    return f"{a}.start < {b}.end and {b}.start < {a}.end"


def instances(found: DataFrame) -> DataFrame:
    """One row per base span, and per identifier-like token that overlaps none: keys, kind (null: unknown), value, start, end, before, left, right."""
    every = "concat(" + ", ".join(f"transform({k}, s -> struct('{k}' as kind, s.start, s.end, s.value, s.before, s.left, s.right))" for k in KINDS) + ")"
    known = found.select(*KEYS, F.expr(f"inline({every})"))
    rest = found.where("size(token) > 0").select(*KEYS, F.expr(f"inline(filter(token, t -> not exists({every}, s -> {_over('s', 't')})))"))
    return known.unionByName(rest.withColumn("kind", F.lit(None).cast("string")))


def _patterns() -> Column:
    """The patterns of an instance."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")
    two = F.when(F.col("before") != "", F.concat_ws(" ", F.lit("LL"), "before", "left"))
    own = [F.concat_ws(" ", F.lit(name), *parts) for name, parts in (("L", ["left"]), ("R", ["right"]), ("B", ["left", "right"]), ("S", [shape]), ("LS", ["left", shape]))]
    return F.explode(F.array_compact(F.array(*own, two))).alias("pattern")


def patterns(rows: DataFrame) -> DataFrame:
    """(value, kind, pattern) of each instance, once."""
    return rows.select("value", "kind", _patterns()).distinct()


def _score(n: Column, of_kind: Column, of_others: Column) -> Column:
    """of_kind: the weights of instances known to be of the kind; of n - of_others - of_kind nothing is known."""
    return of_kind / (of_kind + of_others + (n - of_others - of_kind) * F.when(_shape(), 0.5).otherwise(1.0))


def _shape() -> Column:
    return F.col("pattern").startswith("S ")


def bootstrap(rows: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) after ROUNDS rounds of scoring patterns by instances and instances by patterns."""
    edges = saved(patterns(rows), "pattern-edges")
    seeds = {k: F.count_if(F.col("kind") == k).alias(k) for k in KINDS}
    amount = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *seeds.values()).where(f"n >= {SUPPORT}")
    amount = saved(amount, "patterns")
    unknown = saved(meet(edges.where("kind is null").select("value", "pattern"), amount.select("pattern", F.col("n").alias("size")), ["pattern"], "size").select("value", "pattern"), "pattern-graph")
    by_kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("of_kind"), (sum((F.col(x) for x in KINDS if x != k), F.lit(0))).alias("of_others")) for k in KINDS])).alias("k")
    counted = saved(amount.select("pattern", "n", by_kind).select("pattern", "n", "k.*"), "pattern-counts")
    confident, more = None, None
    for turn in range(ROUNDS):
        now = counted
        if more is not None:  # what is known by now adds its weight and its number
            now = counted.join(more, ["pattern", "kind"], "left").select("pattern", "kind", "n", (F.col("of_kind") + F.coalesce("weight", F.lit(0.0))).alias("of_kind"), "of_others", (F.col("of_kind") + F.coalesce("found", F.lit(0))).alias("support"))
        else:
            now = counted.withColumn("support", F.col("of_kind"))
        scored = now.where(f"support >= {SUPPORT}").withColumn("confidence", _score(F.col("n"), F.col("of_kind"), F.col("of_others"))).where(F.col("confidence") >= F.when(_shape(), CONFIDENT_SHAPE).otherwise(CONFIDENT))
        best = scored.groupBy("pattern").agg(F.max_by(F.struct("kind", "confidence"), F.struct("confidence", "kind")).alias("b"))
        confident = saved(best.select("pattern", "b.kind", "b.confidence"), "confident-patterns")
        if turn + 1 < ROUNDS:
            new = matched(unknown, confident, ["pattern"]).groupBy("value").agg(F.max_by(F.struct("kind", "confidence"), F.struct("confidence", "kind")).alias("b"))
            new = saved(new.select("value", "b.kind", F.col("b.confidence").alias("score")), "discovered-values")
            more = matched(unknown, new, ["value"]).groupBy("pattern", "kind").agg(F.sum("score").alias("weight"), F.count(F.lit(1)).alias("found"))
    return confident


def discovered(rows: DataFrame, confident: DataFrame) -> DataFrame:
    """The row's keys and the spans (start, end, kind) of unknown tokens in confident patterns; the best kind of each."""
    hits = matched(rows.where("kind is null").select(*KEYS, "start", "end", _patterns()), confident, ["pattern"])
    best = hits.groupBy(*KEYS, "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    return best.groupBy(*KEYS).agg(F.collect_list(F.struct("start", "end", "kind")).alias("extra"))


def _listed(spans: str) -> str:
    """SQL: spans as text, by start and then kind as listed."""
    order = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform(array_sort(transform({spans}, s -> struct(s.start, array_position({order}, s.kind) as no, s.end, s.kind))), s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = base(docs)
    rows = saved(instances(found), "instances")
    more = discovered(rows, bootstrap(rows))
    every = "concat(" + ", ".join(f"transform({k}, s -> struct(s.start, s.end, '{k}' as kind))" for k in KINDS) + ")"
    both = found.join(more, KEYS, "left").withColumn("base", F.expr(every))
    return both.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"), F.expr(_listed("concat(base, coalesce(extra, cast(array() as array<struct<start:bigint,end:bigint,kind:string>>)))")).alias("spans"))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
