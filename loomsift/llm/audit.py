"""Filter interaction audit by inclusion-exclusion: what each filter removes in each of the 120 orders.

Every document has five flags, 1 where it fails a filter. One aggregate sums, for each part and each of the 32 sets of
filters, the product of the set's flags: the number of documents that fail all of them (the empty set counts all
documents). These 32 joint-failure counts J, taken over all documents, over those of good quality and over the toxic
ones, say everything else:

* survivors of a set P of filters: the sum over T within P of (-1)**|T| * J(T);
* what a filter removes after the filters P: survivors of P less survivors of P and the filter;
* documents that fail one filter only: Moebius inversion at that filter, the sum over T with it of (-1)**(|T|-1) * J(T);
* redundant failures: J of the filter alone, less what it removes;
* Shapley value: the number that a set of filters removes is a game whose Harsanyi dividend is (-1)**(|T|-1) * J(T),
  and a dividend is shared by its members alike. Over all 120 orders a member gets 120 / |T| of it, a whole number.

So documents are read once for the flags, and the 600 rows of a part come from 96 numbers. Everything is a DataFrame
function. A text equal to one of a smaller doc_id is found by a hash: the least doc_id of each SHA-256 of the texts is
aggregated (map side first), and rows are joined to it by hash and doc_id together, so that the copies of one text,
however many, go to different tasks.

Edge cases: a null text is an empty one (it fails A and none of B, C, D, and E if a smaller doc_id has an empty or null
text); a null doc_id counts as greater than all others, and rows of equal text and equal doc_id fail E or not together;
a null lang and an empty lang are one part; labels that repeat a doc_id count as 1 if one of them is 1, null labels as 0;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import table

FILTERS = "ABCDE"
SETS = range(1 << len(FILTERS))
SPACE = "[\\x20\\x09-\\x0D]+"
#: Stands for a null doc_id: greater than all others.
NO_ID = 2**63 - 1


def failures(text: Column) -> list[Column]:
    """The failure conditions of A to D for a text that is not null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, quality, toxic and the flags A to E, all 0 or 1: a narrow row for each row of docs (doc_id, text, lang)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    one = lambda c: c.cast("int")
    rows = docs.select(doc_id.alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("h"), *[one(f).alias(n) for n, f in zip("ABCD", failures(F.col("text")))])
    least = docs.select(doc_id.alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("h")).groupBy("h").agg(F.min("id").alias("id"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(*[F.max(one(F.coalesce(F.col(c) == 1, F.lit(False)))).alias(c) for c in ("quality", "toxic")])
    rows = rows.join(least.withColumn("first", F.lit(True)), ["h", "id"], "left").drop("h")
    rows = rows.join(marks.where(F.col("id").isNotNull()), "id", "left")
    return rows.select("part", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic")], *"ABCD", one(F.col("first").isNull()).alias("E"))


def joint_failures(flags: DataFrame) -> DataFrame:
    """part and j, jq, jt: for each set of filters (by its bits) the rows that fail all, of all, of quality 1, of toxic 1."""

    def joint(s: int, among: str) -> Column:
        return F.expr(f"sum({' * '.join([f'CAST({among} AS BIGINT)', *[n for k, n in enumerate(FILTERS) if s >> k & 1]])})")

    sums = [joint(s, among).alias(f"{name}{s}") for name, among in (("j", "1"), ("jq", "quality"), ("jt", "toxic")) for s in SETS]
    counts = flags.groupBy("part").agg(*sums)
    return counts.select("part", *[F.array(*[f"{name}{s}" for s in SETS]).alias(name) for name in ("j", "jq", "jt")])


def _signed(counts: str, sets: Column, weight: Column | None = None) -> Column:
    """The sum over the sets T of (-1)**|T| * counts[T], times weight[|T|] if given."""

    def term(t: Column) -> Column:
        value = F.when(F.bit_count(t) % 2 == 0, F.get(F.col(counts), t)).otherwise(-F.get(F.col(counts), t))
        return value if weight is None else value * F.get(weight, F.bit_count(t))

    return F.aggregate(sets, F.lit(0).cast("long"), lambda total, t: total + term(t))


def steps(parts: DataFrame) -> DataFrame:
    """parts with their 600 steps: filter_order, step, own (the filter's bit) and before (the bits of those before it)."""
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    bit = f"shiftleft(1, instr('{FILTERS}', substr(filter_order, k, 1)) - 1)"
    rows = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    return rows.withColumn("own", F.expr(bit.replace(", k,", ", step,"))).withColumn("before", F.expr(f"aggregate(sequence(1, 5), 0, (bits, k) -> IF(k < step, bits | {bit}, bits))"))


def interactions(counts: DataFrame) -> DataFrame:
    """The 600 rows of each part, from its joint-failure counts."""
    every = F.sequence(F.lit(0), F.lit(len(SETS) - 1))
    within = lambda bits: F.filter(every, lambda t: t.bitwiseAND(bits) == t)
    holding = lambda bits: F.filter(every, lambda t: t.bitwiseAND(bits) == bits)
    own, before = F.col("own"), F.col("before")
    after = own.bitwiseOR(before)
    removed = lambda counts: _signed(counts, within(before)) - _signed(counts, within(after))
    shares = F.array(*[F.lit(0), *[F.lit(120 // n) for n in range(1, 6)]])
    return steps(counts).select(
        "part",
        "filter_order",
        "step",
        _signed("j", within(after)).alias("kept"),
        removed("j").alias("removed"),
        (F.get("j", own) - removed("j")).alias("redundant"),
        (-_signed("j", holding(own))).alias("unique_fails"),
        removed("jq").alias("good_lost"),
        removed("jt").alias("toxic_lost"),
        (-_signed("j", holding(own), shares)).alias("shapley"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(joint_failures(flagged(docs, labels)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Counts every order directly, from the rows by the set of filters that they fail.
OP13_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM docs
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS quality, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), flags AS (
    SELECT s.part, coalesce(m.quality, 0) AS quality, coalesce(m.toxic, 0) AS toxic,
        (len(words) < 100)::INT AS a,
        (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
        (100 * (length(s.text) - length(regexp_replace(s.text, '[A-Z]', '', 'g'))) > 10 * length(s.text))::INT AS c,
        regexp_matches(s.text, '[#$%&*|]')::INT AS d,
        coalesce(s.doc_id > f.first_id, s.doc_id IS NULL AND f.first_id IS NOT NULL)::INT AS e
    FROM split s JOIN firsts f ON s.text = f.text LEFT JOIN marks m ON s.doc_id = m.doc_id
), masks AS (
    SELECT part, (CASE WHEN a = 1 THEN 'A' ELSE '' END) || (CASE WHEN b = 1 THEN 'B' ELSE '' END) || (CASE WHEN c = 1 THEN 'C' ELSE '' END)
            || (CASE WHEN d = 1 THEN 'D' ELSE '' END) || (CASE WHEN e = 1 THEN 'E' ELSE '' END) AS failed,
        count(*) AS n, sum(quality) AS good, sum(toxic) AS toxic
    FROM flags GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5
), steps AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier
    FROM orders, range(1, 6) t(step)
), counted AS (
    SELECT m.part, s.filter_order, s.step, s.own,
        sum(CASE WHEN strpos(m.failed, s.own) = 0 AND regexp_replace(m.failed, '[' || s.earlier || '.]', '', 'g') = m.failed THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN strpos(m.failed, s.own) > 0 AND regexp_replace(m.failed, '[' || s.earlier || '.]', '', 'g') = m.failed THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN strpos(m.failed, s.own) > 0 AND regexp_replace(m.failed, '[' || s.earlier || '.]', '', 'g') <> m.failed THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN m.failed = s.own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN strpos(m.failed, s.own) > 0 AND regexp_replace(m.failed, '[' || s.earlier || '.]', '', 'g') = m.failed THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN strpos(m.failed, s.own) > 0 AND regexp_replace(m.failed, '[' || s.earlier || '.]', '', 'g') = m.failed THEN toxic ELSE 0 END) AS toxic_lost
    FROM masks m, steps s GROUP BY ALL
), shares AS (
    SELECT part, own, sum(removed) AS shapley FROM counted GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley
FROM counted JOIN shares USING (part, own)
"""
