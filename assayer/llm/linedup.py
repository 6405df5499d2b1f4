"""Line deduplication over the whole corpus by a deletion-neighbourhood join, in DataFrame operations only.

A line goes when an earlier line of the corpus has the same words, or differs from it by at most one word
inserted, deleted or replaced. Earlier means a smaller (doc_id, line number). The steps:

1. Every line becomes hashes: of its words, and of the first and last half of its words.
2. Equal lines: one aggregate finds the first of each; the others go.
3. Two lines one edit apart have their first or their last half in common, so only lines that share a half
   with a different line can have a partner. Those alone are taken on.
4. Each of them emits all its variants with one word deleted, as hashed keys: running sums of word hashes,
   so a line of n words costs n, not n squared. Equal variants join: with the same word place in both it is
   a replacement, a variant equal to a full line is a deletion. Each key keeps only its earliest line, so a
   group of near copies gives as many rows as it has lines.
5. The edit distance of every match is verified on the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import landed

LEAST_WORDS = 8
PLACE = ("doc_id", "mark", "line_no")


def normal(line: Column) -> Column:
    """Lower case, words parted by one space; only what is not a single space has to be replaced."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, mark, line_no, norm of every line that has a word. ``mark`` tells rows apart that repeat an id.

    A whole text is made lower case and loses its odd blanks at once, as ``normal`` does line by line.
    """
    clean = F.regexp_replace(F.lower("text"), r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")
    lines = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.posexplode(F.split(clean, "\n", -1)).alias("line_no", "line"))
    return lines.select("doc_id", "mark", "line_no", F.trim("line").alias("norm")).where("norm != ''")


def digests(lines: DataFrame, least_words: int) -> DataFrame:
    """Hashes of every line: ``h1``, ``h2`` of all words; ``halves`` of its halves, for lines of ``least_words`` and more.

    Halves are cut for the line as the shorter or the longer one of a pair, whose shorter line has 2m or 2m + 1 words.
    """
    counted = lines.withColumn("n", F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    cut = counted.withColumns({"m1": F.floor(F.col("n") / 2).cast("int"), "m2": F.floor((F.col("n") - 1) / 2).cast("int")})

    def half(m: str, side: int) -> Column:
        return F.xxhash64(F.expr(f"substring_index(norm, ' ', {'-' if side else ''}{m})"), F.col(m), F.lit(side))

    both = F.when(F.col("m1") == F.col("m2"), F.array(half("m1", 0), half("m1", 1)))
    four = both.otherwise(F.array(half("m1", 0), half("m1", 1), half("m2", 0), half("m2", 1)))
    return cut.select(
        *PLACE, F.xxhash64("norm").alias("h1"), F.xxhash64("norm", F.lit(7)).alias("h2"),
        F.when(F.col("n") >= least_words, four).alias("halves"),
    )


def firsts(marks: DataFrame) -> DataFrame:
    """Each different line once, at its earliest place, with its number of places."""
    return marks.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("place"), F.count("*").alias("places"))


def partnered(marks: DataFrame, different: DataFrame) -> DataFrame:
    """The places of the lines that share a half with a different line. Only pairs of hashes travel for that."""
    keys = marks.where("halves is not null").select("h1", F.explode("halves").alias("half"))
    shared = landed(keys.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low != high").select("half"), "shared-halves")
    near = landed(keys.join(shared, "half", "left_semi").select("h1").distinct(), "near-hashes")
    return different.select("h1", "place").join(near, "h1", "left_semi").select("place")


def variants(lines: DataFrame) -> DataFrame:
    """Each line's full key (``gone`` = -1) and its keys with the word at ``gone`` deleted, as two sums of word hashes."""
    words = lines.select("place", F.posexplode(F.split("norm", " ")).alias("at", "word"))
    here, left = F.xxhash64("word", "at"), F.xxhash64("word", F.col("at") - 1)
    parts = words.select("place", "at", *(f(h).alias(name) for h, n in ((here, "here"), (left, "left")) for f, name in ((lambda c: F.shiftrightunsigned(c, 24), f"{n}1"), (lambda c: c.bitwiseAND((1 << 40) - 1), f"{n}2"))))
    line = Window.partitionBy("place")
    upto = line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = parts.select(
        "place", "at", *(F.col(c) for c in ("here1", "here2")),
        *(F.sum(c).over(upto).alias(f"upto_{c}") for c in ("here1", "here2", "left1", "left2")),
        *(F.sum(c).over(line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"all_{c}") for c in ("left1", "left2")),
        F.max("at").over(line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
    )
    keys = F.array(
        F.struct(F.col("at").alias("gone"), *((F.col(f"upto_here{k}") - F.col(f"here{k}") + F.col(f"all_left{k}") - F.col(f"upto_left{k}")).alias(f"v{k}") for k in (1, 2))),
        F.when(F.col("at") == F.col("last"), F.struct(F.lit(-1).alias("gone"), F.col("upto_here1").alias("v1"), F.col("upto_here2").alias("v2"))),
    )
    return sums.select("place", F.explode(keys).alias("key")).where("key is not null").select("place", "key.*")


def met(keys: DataFrame) -> DataFrame:
    """The keys that come more than once; most variants are the only ones of their kind."""
    several = keys.groupBy("v1", "v2").agg(F.count("*").alias("n")).where("n > 1").select("v1", "v2")
    return keys.join(several, ["v1", "v2"], "left_semi")


def earlier_partner(keys: DataFrame) -> DataFrame:
    """place, partner, gone: for each line the earliest line one word edit away, where that one is earlier."""
    deleted, full = F.when(F.col("gone") >= 0, F.col("place")), F.when(F.col("gone") < 0, F.col("place"))
    swapped = keys.where("gone >= 0").groupBy("v1", "v2", "gone").agg(F.min("place").alias("partner"), F.max("place").alias("latest")).where("partner < latest").drop("latest")
    cut = keys.groupBy("v1", "v2").agg(F.min(deleted).alias("deleted"), F.min(full).alias("full")).where("deleted is not null and full is not null")
    offers = swapped.unionByName(cut.select("v1", "v2", F.lit(-1).alias("gone"), F.col("deleted").alias("partner"))).unionByName(
        cut.select("v1", "v2", F.lit(None).cast("int").alias("gone"), F.col("full").alias("partner")))
    offers = landed(offers, "line-offers")
    same_place = keys.join(offers.where("gone is not null"), ["v1", "v2", "gone"]).select("place", "partner", "gone")
    longer = keys.where("gone >= 0").join(offers.where("gone is null").select("v1", "v2", "partner"), ["v1", "v2"]).select("place", "partner", "gone")
    found = same_place.unionByName(longer).where("partner < place")
    return found.groupBy("place").agg(F.min(F.struct("partner", "gone")).alias("best")).select("place", "best.partner")


def one_edit_apart(left: Column, right: Column) -> Column:
    """Whether two word arrays differ by one word at most: what they share at both ends leaves no more than that."""
    a, b = F.size(left), F.size(right)
    short = F.least(a, b)
    differ = F.zip_with(F.slice(left, 1, short), F.slice(right, 1, short), lambda x, y: F.when(x == y, 0).otherwise(1))
    ahead = F.coalesce(F.array_position(differ, 1) - 1, F.lit(0))
    ahead = F.when(F.array_position(differ, 1) == 0, short).otherwise(ahead).cast("int")
    rest_a, rest_b = F.slice(left, ahead + 1, a), F.slice(right, ahead + 1, b)
    tail_a = F.when(a >= b, F.slice(rest_a, 2, a)).otherwise(rest_a)
    tail_b = F.when(b >= a, F.slice(rest_b, 2, b)).otherwise(rest_b)
    return (F.abs(a - b) <= 1) & (tail_a == tail_b)


def removals(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, mark, line_no of every line that goes."""
    marks = landed(digests(lines_of(docs), least_words), "line-digests")
    different = landed(firsts(marks), "first-lines")
    repeated = different.where("places > 1").select("h1", "h2", "place")
    copies = marks.join(repeated, ["h1", "h2"]).where("not (struct(doc_id, mark, line_no) <=> place)").select(*PLACE)

    wanted = partnered(marks, different).groupBy(F.col("place.doc_id").alias("of"), F.col("place.mark").alias("of_mark")).agg(F.collect_set("place.line_no").alias("wanted"))
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    texts = marked.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))).select(
        "doc_id", "mark", F.explode(F.filter(F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("line_no"), line.alias("line"))), lambda x: F.array_contains("wanted", x["line_no"]))).alias("x"))
    candidates = landed(texts.select(F.struct("doc_id", "mark", F.col("x.line_no").alias("line_no")).alias("place"), normal(F.col("x.line")).alias("norm")).groupBy("place").agg(F.min("norm").alias("norm")), "near-lines")
    keys = landed(met(landed(variants(candidates), "line-variants")), "met-variants")
    matched = landed(earlier_partner(keys), "line-matches")
    mine = candidates.select("place", F.split("norm", " ").alias("mine"))
    theirs = candidates.select(F.col("place").alias("partner"), F.split("norm", " ").alias("theirs"))
    near = matched.join(mine, "place").join(theirs, "partner").where(one_edit_apart(F.col("mine"), F.col("theirs"))).select("place.doc_id", "place.mark", "place.line_no")
    return copies.unionByName(near)


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS, count_as: str | None = None) -> DataFrame:
    """``docs`` with the columns it has and ``text`` without the lines that go; ``count_as`` names a column for their number
    (a column of that name is replaced).

    Lines are parted by ``\\n``. Lines without a word always stay; lines of fewer than ``least_words`` words go
    only if an earlier one has the same words. No document goes: one whose lines all go keeps an empty text,
    null stays null. Equal rows have the same places, so each keeps what the first keeps; rows without an id
    come before all others.
    """
    gone = removals(docs, least_words).groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark")).agg(F.collect_set("line_no").alias("numbers")).hint("shuffle_hash")
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["of"]) & (F.xxhash64(docs["text"]) == gone["of_mark"]), "left")
    kept = F.array_join(F.filter(F.split(docs["text"], "\n", -1), lambda line, i: ~F.array_contains(gone["numbers"], i)), "\n")
    text = F.when(gone["numbers"].isNull(), docs["text"]).otherwise(kept)
    count = [F.coalesce(F.size(gone["numbers"]), F.lit(0)).alias(count_as)] if count_as else []
    return joined.select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns if c != count_as), *count)


SQL = r"""
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents
), lines AS (
  SELECT doc_id, line_no, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM split_lines
), firsts AS (
  SELECT norm, min((doc_id, line_no)) AS place FROM lines WHERE norm <> '' GROUP BY norm
), long_lines AS (
  SELECT place, norm, string_split(norm, ' ') AS w FROM firsts WHERE len(string_split(norm, ' ')) >= 8
), shorter AS (
  SELECT place, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v FROM (SELECT place, w, unnest(range(1, len(w) + 1)) AS i FROM long_lines)
), near AS (
  SELECT a.place FROM shorter a JOIN shorter b ON a.v = b.v AND a.i = b.i AND b.place < a.place
  UNION SELECT a.place FROM shorter a JOIN long_lines b ON a.v = b.norm AND b.place < a.place
  UNION SELECT b.place FROM shorter a JOIN long_lines b ON a.v = b.norm AND a.place < b.place
), judged AS (
  SELECT l.doc_id, l.line_no, l.line, l.norm <> '' AND ((l.doc_id, l.line_no) <> f.place OR f.place IN (SELECT place FROM near)) AS gone
  FROM lines l LEFT JOIN firsts f ON l.norm = f.norm
)
SELECT d.doc_id, CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT coalesce(gone, false)), '') END AS text,
       CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN judged USING (doc_id) GROUP BY d.doc_id
"""
