"""Removal of repeated runs of lines, in content-defined chunks, with DataFrame functions only.

Every line that isn't blank has a hash. Several rules choose boundaries side by side: a rolling
hash over the last one or two such lines puts the line into one of two classes by one of its
bits. A chunk runs from the first line of one boundary's window to the next boundary of the same
class, both included, so chunks of a class share a line and a chunk depends on no line outside
it: an inserted line moves no other boundary, and a repeated block holds the same chunks wherever
it stands. Of three neighbouring lines two are in one class, so a repeated block of three or more
lines always holds a whole chunk. Two lines alone do unless all rules put them apart.

Chunks are grouped by digest and bytes over all documents; of equal chunks the first occurrence
stays, by doc_id, text digest and line number. Only digests and places are shuffled first; for
digests that occur twice the bytes follow, line by line. A chunk with very many copies is one row per task before
the shuffle of groups, and its occurrences meet one row in a join that adaptive execution can
split.

`dedup_line_blocks` has no chunks: it compares all pairs of neighbouring lines, which every
repeated block of two or more lines is made of, and leaves none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from .common import documents_of, written

#: Rules for boundaries: lines that the rolling hash covers, and the bit of it that tells the classes.
RULES = ((1, 0), (1, 1), (1, 2), (2, 0))
_FACTOR = 31
#: A span is one number: its first line times this, plus its last.
_SPAN = 1 << 31
_BLANK = r"[^ \t\r\f\x0B]"


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with one more column that is computed once per row: lambdas that use it would
    otherwise repeat its expression for each of their elements."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _class_spans(hashes: Column, window: int, bit: int, kind: int) -> Column:
    """The chunks of the lines whose hash over ``window`` lines has ``kind`` as its ``bit``."""

    def fits(j: Column) -> Column:
        return (j >= window - 1) & (F.shiftright(F.get(hashes, j), bit).bitwiseAND(F.lit(1)) == kind)

    def chunks(marks: Column) -> Column:
        return F.transform(F.slice(marks, 2, F.size(marks)), lambda end, k: (
            F.get("full", F.get(marks, k) - (window - 1)).cast("long") * _SPAN + F.get("full", end)))

    # In an array of one, so that the marks are found once for both ends of the chunks.
    marks = F.array(F.filter(F.sequence(F.lit(0), F.size("full") - 1), fits))
    return F.flatten(F.transform(marks, chunks))


def _spans(rules: Sequence[tuple[int, int]]) -> Column:
    """The chunks of all rules, each once, from ``full`` (numbers of the lines that aren't blank)
    and ``rolled`` (for each window its rolling hashes, in the order of `_windows`)."""
    return F.array_distinct(F.concat(*[
        _class_spans(F.get("rolled", _windows(rules).index(w)), w, bit, kind) for w, bit in rules for kind in (0, 1)]))


def _windows(rules: Sequence[tuple[int, int]]) -> list[int]:
    return sorted({w for w, _ in rules})


def chunk_places(docs: DataFrame, rules: Sequence[tuple[int, int]], digest_chars: int) -> DataFrame:
    """doc_id, text_md5, start, n_lines and digest: one row per chunk, without its bytes."""
    lined = documents_of(docs).filter(F.contains("text", F.lit("\n")))
    lined = _once(lined.withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary")))), "lines", F.split("text", "\n", -1)).drop("text")
    lined = _once(lined, "full", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(_BLANK)))
    lined = _once(lined.filter(F.size("full") > 1), "hashes", F.transform("full", lambda i: _line_hash(F.get("lines", i))))

    def rolled(window: int) -> Column:
        return F.transform("hashes", lambda _, j: reduce(add, [
            F.coalesce(F.get("hashes", j - back), F.lit(0).cast("long")) * _FACTOR**back for back in range(window)]))

    lined = _once(lined, "rolled", F.array(*[rolled(w) for w in _windows(rules)]))
    lined = _once(lined, "spans", _spans(rules))
    # Digests before the explode, which would copy the lines for each chunk.
    places = F.transform("spans", lambda s: _place(s, digest_chars))
    rows = lined.select("doc_id", "text_md5", places.alias("places")).select("doc_id", "text_md5", F.explode("places").alias("p"))
    return rows.select("doc_id", "text_md5", "p.*")


def _chunk(start: Column, n_lines: Column) -> Column:
    return F.array_join(F.slice("lines", start + 1, n_lines), "\n")


def _place(span: Column, digest_chars: int) -> Column:
    start = F.shiftright(span, 31).cast("int")
    n_lines = (span.bitwiseAND(F.lit(_SPAN - 1)) - start + 1).cast("int")
    digest = F.unhex(F.substring(F.md5(_chunk(start, n_lines).cast("binary")), 1, digest_chars))
    return F.struct(start.alias("start"), n_lines.alias("n_lines"), digest.alias("digest"))


def _later(found: DataFrame, first: DataFrame, key: list[str]) -> DataFrame:
    """``found`` with ``repeat``: whether the row is neither the first of its ``key`` nor overlaps it."""
    own = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_md5") == F.col("stays.text_md5"))
    near = own & (F.col("start") - F.col("stays.start") < F.col("n_lines"))
    return found.join(first, key).withColumn("repeat", ~near).drop("stays")


def _with_cuts(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    """``keyed`` with the column ``cuts`` of its document; null ids are equal to each other."""
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_md5") == F.col("c.text_md5"))
    return keyed.alias("d").join(cuts.alias("c"), same, "left").select("d.*", "c.cuts")


def _mixed_digests(several: DataFrame, line_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The digests in ``cuts`` that chunks of different bytes may share.

    Chunks of several rules overlap, so their bytes are compared line by line: each line is sent
    once for its document, to show that no hash stands for two lines, and a chunk is the list of
    its lines' hashes. Digests of chunks with a hash that does stand for two lines count as shared."""
    hashed = _once(several, "hashes", F.transform("lines", lambda line: line_hash(line)))
    hashed = _once(hashed, "covered", F.array_distinct(F.flatten(F.transform(
        "cuts", lambda c: F.sequence(c["start"], c["start"] + c["n_lines"] - 1)))))
    lines = hashed.select(F.explode(F.transform("covered", lambda i: F.struct(
        F.get("hashes", i).alias("hash"), F.get("lines", i).alias("line")))).alias("l")).select("l.*")
    distinct = lines.groupBy("hash", "line").agg(F.count(F.lit(1)).alias("copies"))
    clash = written(distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("hash"), "line-clash")
    chunks = hashed.select(F.explode(F.transform("cuts", lambda c: F.struct(
        c["digest"].alias("digest"), F.slice("hashes", c["start"] + 1, c["n_lines"]).alias("hashes")))).alias("p")).select("p.*")
    kinds = chunks.groupBy("digest", "hashes").agg(F.count(F.lit(1)).alias("copies"))
    shared = kinds.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
    if not clash.isEmpty():
        unsure = kinds.select("digest", F.explode("hashes").alias("hash")).join(clash, "hash", "left_semi").select("digest")
        shared = shared.union(unsure).distinct()
    return written(shared, "line-mixed")


def dedup_lines(docs: DataFrame, rules: Sequence[tuple[int, int]] = RULES, digest_chars: int = 32) -> DataFrame:
    """doc_id, n_lines, n_removed_chunks, n_removed_lines and the text that is left.

    Lines end at "\\n". A null text counts as empty; an empty text is one empty line and keeps
    it. A line goes with a chunk of two or more lines that stood earlier, never alone. Blank
    lines make no chunk, but go with one that holds them. A chunk that only overlaps its own
    first occurrence, as in a run of three equal lines, is no repeat. Rows equal in doc_id and
    text are one occurrence, so neither loses anything to the other; rows that share a doc_id with
    different texts are judged separately; rows with a null id come before all others and lose
    repeats like them. Texts of any length are cut whole. An empty table gives an empty table;
    further columns are ignored. ``digest_chars`` shortens the digest; chunks with one digest and
    different bytes are still told apart.
    """
    here, key = F.struct("doc_id", "text_md5", "start"), ["doc_id", "text_md5"]
    places = written(chunk_places(docs, rules, digest_chars), "line-places")
    repeated = written(places.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("digest"), "line-digests")
    found = written(places.join(repeated, "digest"), "line-repeated")
    # Written first, so that the join with a hot digest's rows can be split.
    first = written(found.groupBy("digest").agg(F.min(here).alias("stays")), "line-firsts")
    cuts = _later(found, first, ["digest"]).groupBy(*key).agg(
        F.collect_set(F.struct("start", "n_lines", "digest", "repeat")).alias("cuts"))
    keyed = documents_of(docs).withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    # A text of one line has no chunk, so it needs no look for cuts.
    many = F.contains("text", F.lit("\n"))
    lined = keyed.filter(many)
    marked = written(_with_cuts(lined, cuts), "line-marked", "zstd")

    # The comparison of bytes, only of chunks whose digest occurs twice.
    several = _once(marked.filter("cuts is not null"), "lines", F.split("text", "\n", -1)).drop("text")
    mixed = _mixed_digests(several)
    marked = marked.withColumn("cuts", F.filter("cuts", lambda c: c["repeat"]))
    if not mixed.isEmpty():
        # Different texts with one digest: these are told apart by the bytes themselves.
        chunks = several.select(*key, F.explode(F.transform("cuts", lambda c: F.struct(
            c["start"].alias("start"), c["n_lines"].alias("n_lines"), c["digest"].alias("digest"), _chunk(c["start"], c["n_lines"]).alias("chunk")))).alias("p"))
        apart = chunks.select(*key, "p.*").join(mixed, "digest", "left_semi")
        first = written(apart.groupBy("digest", "chunk").agg(F.min(here).alias("stays")), "line-firsts")
        exact = _later(apart, first, ["digest", "chunk"]).filter("repeat").select(*key, "start", "n_lines")
        plain = marked.select(*key, F.explode("cuts").alias("c")).select(*key, "c.*").join(mixed, "digest", "left_anti")
        cuts = plain.select(*key, "start", "n_lines").union(exact).groupBy(*key).agg(F.collect_set(F.struct("start", "n_lines")).alias("cuts"))
        marked = _with_cuts(lined, cuts)
    else:
        marked = marked.withColumn("cuts", F.transform("cuts", lambda c: F.struct(c["start"].alias("start"), c["n_lines"].alias("n_lines"))))
    alone = keyed.filter(~many).withColumn("cuts", F.lit(None).cast("array<struct<start int, n_lines int>>"))
    marked = marked.unionByName(alone)
    marked = _once(marked, "lines", F.split("text", "\n", -1))
    covered = F.flatten(F.transform("cuts", lambda c: F.sequence(c["start"], c["start"] + c["n_lines"] - 1)))
    marked = _once(marked, "gone", F.array_distinct(covered))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    untouched = F.coalesce(F.size("cuts") <= 0, F.lit(True))
    return marked.select(
        "doc_id", F.size("lines").alias("n_lines"),
        F.when(untouched, 0).otherwise(F.size("cuts")).alias("n_removed_chunks"),
        F.when(untouched, 0).otherwise(F.size("gone")).alias("n_removed_lines"),
        F.when(untouched, F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")).alias("text"))


def _repeats(found: DataFrame, apart: Column) -> DataFrame:
    """doc_id, text_md5, start and n_lines of the rows of ``found`` whose digest and bytes an
    earlier row has. ``apart`` tells a row from that first one, whose place is ``stays``."""
    here = F.struct("doc_id", "text_md5", "start")
    # The bytes are part of the key: this is the comparison. Only digests and counts go on.
    kinds = found.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("copies")).drop("chunk")
    repeated = written(
        kinds.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("copies").alias("copies")).filter("copies > 1"),
        "line-digests")
    places = written(found.drop("chunk").join(repeated.filter("texts = 1").select("digest"), "digest"), "line-places")
    # Written first, so that the join with a hot digest's rows can be split.
    first = written(places.groupBy("digest").agg(F.min(here).alias("stays")), "line-firsts")
    cut = ["doc_id", "text_md5", "start", "n_lines"]
    repeats = places.join(first, "digest").filter(apart).select(*cut)
    mixed = repeated.filter("texts > 1").select("digest")
    if not mixed.isEmpty():
        # Different texts with one digest: their occurrences are joined by the bytes themselves.
        several = found.join(mixed, "digest", "left_semi")
        first = several.groupBy("digest", "chunk").agg(F.min(here).alias("stays"))
        repeats = repeats.union(several.join(first, ["digest", "chunk"]).filter(apart).select(*cut))
    return repeats.distinct()


def line_pairs(docs: DataFrame, digest_chars: int) -> DataFrame:
    """The columns of `chunk_places` and the bytes as ``chunk``, one row per pair of neighbouring
    lines that aren't blank. Blank lines between the two belong to the pair."""
    lined = documents_of(docs).filter(F.contains("text", F.lit("\n")))
    lined = _once(lined.withColumn("text_md5", F.md5(F.col("text").cast("binary"))), "lines", F.split("text", "\n", -1)).drop("text")
    lined = _once(lined, "full", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(r"\S")))

    def pair(j: Column) -> Column:
        start, n = F.get("full", j), F.get("full", j + 1) - F.get("full", j) + 1
        return F.struct(start.alias("start"), n.alias("n_lines"), F.array_join(F.slice("lines", start + 1, n), "\n").alias("chunk"))

    some = lined.filter(F.size("full") > 1)
    pieces = F.transform(F.sequence(F.lit(0), F.size("full") - 2), pair)
    rows = some.select("doc_id", "text_md5", F.explode(pieces).alias("p"))
    return rows.select("doc_id", "text_md5", "p.start", "p.n_lines",
                       F.substring(F.md5(F.col("p.chunk").cast("binary")), 1, digest_chars).alias("digest"), "p.chunk")


def dedup_line_blocks(docs: DataFrame, digest_chars: int = 32) -> DataFrame:
    """doc_id, n_lines, n_removed_lines and the text that is left.

    Removes every line inside a block of two or more lines that stood earlier (by doc_id, text
    digest and line number), wherever the block begins or ends. Blank lines don't make a block,
    but go with one that holds them. The first occurrence of a line always stays. A pair that
    only overlaps its own first occurrence, as in a run of three equal lines, is no repeat.
    Lines, nulls, empty texts, repeated ids and ``digest_chars`` are as in `dedup_lines`; rows
    with a null id come before all others and lose repeats like them.
    """
    own = (F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))) & (F.col("text_md5") == F.col("stays.text_md5"))
    repeats = _repeats(line_pairs(docs, digest_chars), ~(own & (F.col("start") - F.col("stays.start") < F.col("n_lines"))))
    cuts = repeats.groupBy("doc_id", "text_md5").agg(F.collect_list(F.struct("start", "n_lines")).alias("cuts"))
    keyed = documents_of(docs).withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_md5") == F.col("c.text_md5"))
    marked = keyed.alias("d").join(cuts.alias("c"), same, "left").select("d.doc_id", "text", "cuts")
    marked = _once(marked, "lines", F.split("text", "\n", -1))
    covered = F.flatten(F.transform("cuts", lambda c: F.sequence(c["start"], c["start"] + c["n_lines"] - 1)))
    marked = _once(marked, "gone", F.array_distinct(covered))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    untouched = F.col("cuts").isNull()
    return marked.select(
        "doc_id", F.size("lines").alias("n_lines"), F.when(untouched, 0).otherwise(F.size("gone")).alias("n_removed_lines"),
        F.when(untouched, F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")).alias("text"))
