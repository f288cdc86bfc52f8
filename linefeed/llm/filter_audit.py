"""How quality filters interact, whatever order they are applied in (operator 13).

Five filters each fail some documents.  What a filter removes depends on
the ones before it, but only through the set of filters a document fails;
so every document becomes a bit mask, the masks are counted, and all 120
orders are worked out from at most 32 counts a part.

1. One scan gives every document its part, a hash of its text and the
   bits of the filters that look at the text alone (A to D).
2. Duplicates (E) are found by an existential self-join: a left-semi join
   on the hash, the exact text and a smaller id.  Only texts whose hash
   several ids have take part (these hashes are broadcast behind a size
   check), and their other side is one row per text, its smallest id.  A text with more than 1/``SHARES`` of all rows is
   dealt over salts in proportion; there are at most ``SHARES`` such
   texts, so the list of them is broadcast.
3. The ids that E fails are united with the others; a bitwise or per
   document gives its mask, and masks are counted per part.

Everything is DataFrame functions.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefeed.llm.common import named, saved
from linefeed.operators.joins import join_dimension

FILTERS = "ABCDE"
#: A text is hot from this share of the rows on (1/SHARES), and a salt holds about so many.
SHARES = 2000
#: What parts words (as a class of Java and RE2), and the marks that filter D looks for.
BLANKS, MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
#: Fixed values of the filters: words wanted, per cent of distinct words wanted, per cent of capitals allowed.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5


def text_failures(text: Column) -> Column:
    """The bits of filters A to D that a text fails (A is 1, B 2, C 4, D 8).

    A text without words fails A alone: 0 distinct words are not under 65
    per cent of 0, and no code points hold no capitals.
    """
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    # the words are split once; both counts come from the same array
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    few = F.transform(F.array(counts), lambda c: (c["n"] < LEAST_WORDS).cast("int")
                      + (100 * c["d"] < LEAST_DISTINCT * c["n"]).cast("int") * 2)[0]
    return (few + (100 * capitals > MOST_CAPITALS * F.length(text)).cast("int") * 4
            + text.rlike(MARKS).cast("int") * 8)


def duplicates(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose whole text a row with a smaller id also has: ``doc_id, part, h``.

    ``rows`` has ``doc_id, part, text, h``, ``marks`` the same without texts,
    saved.  A null id is smaller or larger than no other.
    """
    total = max(1, marks.count())
    several = (marks.where("doc_id is not null").groupBy("h")
               .agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
               .where("low < high")
               .withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("n") * SHARES / total)).cast("int")))
    several = saved(several.select("h", "salts"))
    hot = several.where("salts > 1")  # each has over 1/SHARES of the rows: SHARES rows at most

    def over_salts(df: DataFrame) -> DataFrame:
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    salted = (rows.where("doc_id is not null").join(F.broadcast(hot), "h", "left")
              .withColumn("salt", F.when(F.col("salts").isNull(), 0)
                          .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts"))).cast("int")).drop("salts"))
    # broadcast if its size check passes, so that texts on one row are not shuffled; else a salted shuffle
    several_rows = join_dimension(salted, over_salts(several), ["h", "salt"], "left_semi")
    earliest = (several_rows.groupBy("h", "salt", "text").agg(F.min("doc_id").alias("least"))
                .groupBy("h", "text").agg(F.min("least").alias("least"))
                .join(F.broadcast(hot), "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1))))
    left, right = several_rows.alias("l"), over_salts(earliest).alias("r")
    same = ((F.col("l.h") == F.col("r.h")) & (F.col("l.salt") == F.col("r.salt"))
            & (F.col("l.text") == F.col("r.text")) & (F.col("r.least") < F.col("l.doc_id")))
    return left.join(right, same, "left_semi").select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """Per part and mask of failed filters: ``part, mask, n, good, toxic`` (documents, labelled ones among them).

    A null part or text is empty; a null id is a document that equals none
    and has no label.  Rows that repeat are documents each, and none of
    them is a duplicate of another with the same id.  Several labels of
    one id count as one, positive if any is.  Columns not named are not
    read.
    """
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(part_col), F.lit("")).alias("part"),
                       F.coalesce(named(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    marks = saved(rows.select("doc_id", "part", "h", text_failures(F.col("text")).alias("mask")))
    copies = duplicates(rows, marks)
    failed = (marks.withColumn("one", F.lit(1)).unionAll(
        copies.select("doc_id", "part", "h", F.lit(1 << FILTERS.index("E")).alias("mask"), F.lit(0).alias("one")))
        .groupBy("doc_id", "part", "h").agg(F.bit_or("mask").alias("mask"), F.sum("one").alias("n")))
    told = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
            .groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                   F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = failed.where("doc_id is not null").join(told, "doc_id", "left")
    nameless = failed.where("doc_id is null").withColumns({"good": F.lit(None).cast("int"),
                                                           "toxic": F.lit(None).cast("int")})
    return known.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, order of the filters and step, what the step's filter does, from ``combinations``.

    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.  A part's counts are one row of at
    most 32 entries; it becomes a row per order and step.  ``shapley``
    needs no orders: a filter removes a document in those where it comes
    first of the k it fails, one in k of all.  No parts give no rows.
    """
    orders = ["".join(p) for p in permutations(filters)]
    steps = F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(step + 1).alias("step"),
                               F.lit(1 << filters.index(order[step])).alias("bit"),
                               F.lit(sum(1 << filters.index(f) for f in order[:step])).alias("earlier"))
                      for order in orders for step in range(len(filters))])
    entry = F.struct("mask", F.col("n").alias("n"), "good", "toxic")
    shapley = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n") * F.expr(
        f"{len(orders)} div bit_count(mask)")).otherwise(0)).cast("long").alias(f"s{i}") for i in range(len(filters))]
    each = counted.groupBy("part").agg(F.collect_list(entry).alias("m"), F.array(*shapley).alias("shapley"))
    each = each.select("part", "m", "shapley", F.inline(steps))

    def total(which, what: str) -> Column:
        return F.aggregate(F.filter("m", which), F.lit(0).cast("long"), lambda a, x: a + x[what])

    bit, earlier = F.col("bit"), F.col("earlier")

    def fails(x) -> Column:
        return x["mask"].bitwiseAND(bit) != 0

    def reached(x) -> Column:
        return x["mask"].bitwiseAND(earlier) == 0

    return each.select(
        "part", "filter_order", "step",
        total(lambda x: reached(x) & ~fails(x), "n").alias("kept"),
        total(lambda x: reached(x) & fails(x), "n").alias("removed"),
        total(lambda x: ~reached(x) & fails(x), "n").alias("redundant"),
        total(lambda x: x["mask"] == bit, "n").alias("unique_fails"),
        total(lambda x: reached(x) & fails(x), "good").alias("good_lost"),
        total(lambda x: reached(x) & fails(x), "toxic").alias("toxic_lost"),
        F.col("shapley")[F.log2(bit).cast("int")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all documents by their source."""
    return audit(combinations(docs, labels))


#: The same in DuckDB, order by order.
ORACLE = """
WITH rows AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS e
  FROM rows
), told AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(told.toxic, 0) AS toxic,
         (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM split LEFT JOIN told USING (doc_id)
), counted AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), applied AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS failed, fails = f AS alone,
         earlier <> '' AND regexp_matches(fails, '[' || (CASE WHEN earlier = '' THEN 'x' ELSE earlier END) || ']') AS gone
  FROM counted, steps
), shares AS (
  SELECT part, f, CAST(sum(n) AS BIGINT) AS shapley FROM applied WHERE failed AND NOT gone GROUP BY part, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failed), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND failed), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (WHERE gone AND failed), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (WHERE alone), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND failed), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND failed), 0) AS BIGINT) AS toxic_lost,
       coalesce(max(shapley), 0) AS shapley
FROM applied LEFT JOIN shares USING (part, f) GROUP BY part, filter_order, step
"""


def brute_force(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """The audit's rows, every order applied document by document; for tests."""
    import re
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)),
            i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)), strict=True) if bad}
        own = [(q, t) for j, q, t in labels if j is not None and j == i]
        rows.append((part or "", fails, any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations(FILTERS)):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                everyone = [r for r in rows if r[0] == part and f in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), len(everyone) - len(gone),
                            sum(r[1] == {f} for r in everyone), sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]
