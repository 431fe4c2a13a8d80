"""I-Match fingerprints, with DataFrame functions only.

Terms whose inverse document frequency lies in a band are kept; what all texts use and what few texts use is ignored. The
distinct terms of a text that fall in the band are put in order and hashed, once for each of several random parts of the lexicon.

Terms go by their 64-bit hash. Document frequencies are exact; of them only the band is kept, whose size does not follow the number of texts: a term that every 2^hi-th
text holds occurs that often, so there are at most 2^hi times the mean number of terms of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialize

#: The band in bits of idf: terms of at most one in 2 and at least one in 512 documents.
BAND = (1.0, 9.0)
#: One lexicon keeps a term with probability 2^-halvings. The first are nearly whole lexicons, the last a few terms of a text.
HALVINGS = (1, 1, 2, 3, 4, 5, 6, 6, 7, 7, 7, 7, 8, 8, 8, 8)


def terms_of(text: Column) -> Column:
    """Hashes of a text's distinct terms: lower-cased runs of letters and digits."""
    terms = F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda t: t != "")
    return F.transform(terms, lambda t: F.xxhash64(t))


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """(term, parts): the terms in the band over all texts, with the lexicon parts a term belongs to as bits of a number."""
    held = texts.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = texts.count()
    inside = held.filter((F.col("df") * 2.0 ** band[0] <= n) & (F.col("df") * 2.0 ** band[1] >= n))
    parts = F.lit(0)
    for k, halvings in enumerate(HALVINGS):
        parts = parts + F.when(F.pmod(F.xxhash64("term", F.lit(k)), F.lit(1 << halvings)) == 0, 1 << k).otherwise(0)
    return inside.select("term", parts.alias("parts"))


def fingerprints(rows: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """(keys, signature) for rows with a text: an array with a hash for each lexicon part, NULL where the text has no term of it.

    A text's terms in the band are put in order once; a part's hash is that of the ordered terms it has. Rows must differ in ``keys``; rows that are
    already together by a part of ``keys`` are not shuffled.
    """
    terms = rows.select(*keys, F.explode_outer(terms_of(F.col("text"))).alias("term"))
    met = terms.join(F.broadcast(words), "term", "left")
    known = F.collect_list(F.when(F.col("parts").isNotNull(), F.struct("term", "parts")))
    made = met.groupBy(*keys).agg(F.array_sort(known).alias("_terms"))

    def part(k: int) -> Column:
        own = F.filter("_terms", lambda t: t["parts"].bitwiseAND(1 << k) != 0)
        return F.when(F.exists("_terms", lambda t: t["parts"].bitwiseAND(1 << k) != 0), F.xxhash64(F.transform(own, lambda t: t["term"])))

    return made.select(*keys, F.array(*[part(k) for k in range(len(HALVINGS))]).alias("signature"))


def fingerprint_text(signature: Column, text_hash: Column) -> Column:
    """The signature as text; of a text without any term in the band, its own hash, so that only equal texts agree."""
    shown = F.concat_ws("-", F.transform(signature, lambda x: F.coalesce(F.hex(x), F.lit("."))))
    return F.when(F.exists(signature, lambda x: x.isNotNull()), shown).otherwise(F.concat(F.lit("text-"), F.hex(text_hash)))


def likeness(left: Column, right: Column, left_hash: Column, right_hash: Column) -> Column:
    """Share of lexicon parts with equal hashes, among those in which either text has terms; 1 for equal texts, 0 when neither has terms."""
    both = F.zip_with(left, right, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise((x.eqNullSafe(y)).cast("int")))
    known = F.filter(both, lambda x: x.isNotNull())
    same = F.size(F.filter(known, lambda x: x == 1))
    return F.when(left_hash == right_hash, 1.0).when(F.size(known) > 0, same / F.size(known)).otherwise(0.0).cast("double")


def _slices(rows: DataFrame, rows_in_slice: int, most: int = 65_536) -> Column:
    """A number that grows with doc_id and has about equally many rows for each value, at most ``most`` values; -1 for a NULL id."""
    n = rows.count()
    fine = max(1, min(most, n // rows_in_slice) // 64)
    shares = [i / 64 for i in range(65)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in shares]), F.lit(10_000)).alias("b")).first()["b"] or [0]))
    out = F.when(F.col("doc_id").isNull(), F.lit(-1))
    for i, low in enumerate(bounds):
        if i + 1 < len(bounds):
            place = F.floor((F.col("doc_id") - low) * float(fine) / float(bounds[i + 1] - low)).cast("int")
            out = out.when(F.col("doc_id") < bounds[i + 1], F.greatest(F.lit(0), F.least(place, F.lit(fine - 1))) + i * fine)
    return out.otherwise(len(bounds) * fine)


def with_next(documents: DataFrame, rows_in_slice: int = 500) -> DataFrame:
    """(slice, at, extra, doc_id, text, next_text): the text of the next document by ascending id; the first one's follows the last.

    Equal ids follow each other by text hash, NULL ids come first; a NULL text is empty. Documents are cut into slices by id, and the first one of each
    slice is copied to the end of the slice before as an ``extra`` row, so no order runs over all of them.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("slice", _slices(documents.select("doc_id"), rows_in_slice)).withColumn("_order", F.xxhash64("text"))
    first = rows.groupBy("slice").agg(F.min(F.struct("doc_id", "_order")).alias("_first"))
    round_trip = Window.orderBy("slice")  # over one row for each slice, 65,600 at most
    last = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = materialize(first.select("slice", "_first", F.coalesce(F.lag("slice").over(round_trip), F.last("slice").over(last)).alias("_before")), "imatch_slices")
    before = before.select(F.col("slice").alias("_slice"), F.col("_first.doc_id").alias("_id"), F.col("_first._order").alias("_o"), "_before")
    extra = rows.join(F.broadcast(before), (F.col("slice") == F.col("_slice")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_order") == F.col("_o")))
    both = rows.select("slice", F.lit(False).alias("extra"), "doc_id", "_order", "text").union(extra.select("_before", F.lit(True), "doc_id", "_order", "text"))
    within = Window.partitionBy("slice").orderBy("extra", "doc_id", "_order")
    return both.select("slice", F.row_number().over(within).alias("at"), "extra", "doc_id", "text", F.lead("text").over(within).alias("next_text"))


def edited_fingerprints(documents: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``documents``.

    The edited text is the text with its last half (rounded down, in code points) replaced by as much of the next document's beginning
    as there is. A NULL text counts as empty. The lexicon comes from all texts as they are. Repeated rows are each other's neighbours.

    Whole texts are shuffled once, by slices of ids; all that follows stays in the slice.
    """
    words = materialize(lexicon(documents.select(F.coalesce("text", F.lit("")).alias("text")), band), "imatch_lexicon")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(documents).select("slice", "at", "extra", "doc_id", "text", n.alias("n_chars"), edited.alias("edited"))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"), F.lit(None).cast("binary").alias("sha")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"), F.unhex(F.sha2(F.col("edited"), 256)).alias("sha")),
    )
    two = rows.select("slice", "at", "extra", "doc_id", "n_chars", F.explode(kinds).alias("k")).filter(~F.col("extra") | (F.col("k.kind") == 0))
    two = two.select("slice", "at", "extra", "doc_id", "n_chars", "k.kind", "k.text", "k.sha", F.xxhash64("k.text").alias("text_hash"))
    made = fingerprints(two, ["slice", "at", "extra", "doc_id", "n_chars", "kind", "sha", "text_hash"], words)
    side = F.struct("signature", "text_hash", "sha")
    joined = made.groupBy("slice", "at", "extra", "doc_id", "n_chars").agg(F.max(F.when(F.col("kind") == 0, side)).alias("own"), F.max(F.when(F.col("kind") == 1, side)).alias("edit"))
    following = joined.withColumn("next", F.lead("own").over(Window.partitionBy("slice").orderBy("at"))).filter(~F.col("extra"))
    return following.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.lower(F.hex("edit.sha")).alias("edited_sha256"),
        fingerprint_text(F.col("own.signature"), F.col("own.text_hash")).alias("fingerprint"), fingerprint_text(F.col("edit.signature"), F.col("edit.text_hash")).alias("edited_fingerprint"),
        likeness(F.col("own.signature"), F.col("edit.signature"), F.col("own.text_hash"), F.col("edit.text_hash")).alias("near_edited"),
        likeness(F.col("own.signature"), F.col("next.signature"), F.col("own.text_hash"), F.col("next.text_hash")).alias("near_next"),
    )
