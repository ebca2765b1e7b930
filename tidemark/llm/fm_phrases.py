"""Collocations mined with an FM-index per shard.

A shard is a run of a partition's texts of one language, as word numbers with a mark (0) between pieces. Its index is the
Burrows-Wheeler transform of the words and that of the reversed words, both sorted by contexts of max_words words: that
deep, an interval of the one holds all occurrences of a phrase, and its twin in the other all of the reversed phrase.
Extending a phrase by a word on the left splits its interval by the words before (the forward transform), on the right by
the words behind (the reverse one); the twin follows by counting smaller words. All phrases of a length are extended at
once: a stable sort of the transform lists, for every word, its occurrences in order, in which each (word, interval) is
one run; the run's place is the extended interval and its length the count.

Phrases are enumerated by length. Shards send (phrase, count) in packed arrays to the bucket of the phrase's hash, where
the sums over all shards are taken; phrases seen ``least`` times or more stay. A phrase can only be that frequent if its
parts are, so a shard extends a phrase only if a bitmap of fixed size says that it may be frequent (its false hits cost
time, nothing else). A shard sends a phrase once, whatever its count, so frequent ones are as many rows as shards.

Defined cases: null texts are empty; a null language is UNKNOWN; A-Z become a-z; words are longest runs of anything but
spaces and tabs within a piece, pieces end at STOP; rows repeat as they come (each counts); a language without a phrase
frequent enough has no rows; equal scores and counts: phrases by their UTF-8 bytes. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C

SPACE, STOP = b" \t", b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Bytes of text of a shard, and words of the corpus for each bucket.
SHARD_BYTES, BUCKET_WORDS = 8_000_000, 1_000_000
#: 2**BITMAP bits tell which phrases may be frequent.
BITMAP = 26


@dataclass
class Level:
    """Phrases of one length: their words (a column each), intervals in both transforms, and how often they occur."""

    words: np.ndarray
    forward: np.ndarray
    reverse: np.ndarray
    count: np.ndarray


def _transform(words: np.ndarray, depth: int) -> np.ndarray:
    """The word before each place, places sorted by the next ``depth`` words (cyclic; the last word is 0)."""
    rank = words.astype(np.int64)
    for _ in range(depth - 1):
        key = words * (rank.max() + 1) + np.roll(rank, -1)
        order = np.argsort(key)
        new = np.empty(len(key), bool)
        new[:1], new[1:] = False, key[order][1:] != key[order][:-1]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new)
    order = np.argsort(rank, kind="stable")
    return words[order - 1].astype(np.int32)


@dataclass
class Index:
    """forward, reverse: the transforms; listed: for each, the places of every word in turn (a stable sort)."""

    forward: np.ndarray
    reverse: np.ndarray
    listed: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, forward: np.ndarray, reverse: np.ndarray) -> Index:
        return cls(forward, reverse, (np.argsort(forward, kind="stable"), np.argsort(reverse, kind="stable")))

    @classmethod
    def build(cls, words: np.ndarray, depth: int) -> Index:
        """words: numbers from 1, 0 between pieces and at the end."""
        back = np.append(words[:-1][::-1], 0)
        return cls.of(_transform(words.astype(np.int64), depth), _transform(back.astype(np.int64), depth))

    def first(self) -> Level:
        """All words."""
        n = np.bincount(self.forward)
        start = np.cumsum(n) - n
        w = np.flatnonzero(n[1:]) + 1
        return Level(w[:, None].astype(np.int32), start[w], start[w].copy(), n[w])

    def extend(self, level: Level, left: bool) -> Level:
        """Every phrase of the level with each word that occurs before it (left) or behind it."""
        symbols, listed = (self.forward, self.listed[0]) if left else (self.reverse, self.listed[1])
        own, twin = (level.forward, level.reverse) if left else (level.reverse, level.forward)
        phrase = np.full(len(symbols), -1, np.int32)
        ends = np.cumsum(level.count)
        phrase[np.arange(ends[-1] if len(ends) else 0) + np.repeat(own - (ends - level.count), level.count)] = np.repeat(np.arange(len(own), dtype=np.int32), level.count)
        at = phrase[listed]
        word = symbols[listed]
        held = np.flatnonzero((at >= 0) & (word > 0))
        at, word = at[held], word[held]
        new = np.ones(len(held), bool)
        new[1:] = (at[1:] != at[:-1]) | (word[1:] != word[:-1])
        run = np.flatnonzero(new)
        count = np.diff(np.append(run, len(held)))
        parent, word, place = at[run], word[run], held[run]
        # the twin: behind the parent's occurrences at a piece's edge and those with smaller words
        order = np.argsort(parent, kind="stable")
        before = np.cumsum(count[order]) - count[order]
        begins = np.searchsorted(parent[order], np.arange(len(own)))
        edge = level.count - np.bincount(parent, weights=count, minlength=len(own)).astype(np.int64)
        inside = np.append(before, 0)[np.minimum(begins, len(before))]
        other = np.empty(len(run), np.int64)
        p = parent[order]
        other[order] = twin[p] + edge[p] + before - inside[p]
        old, w = level.words[parent], word[:, None].astype(np.int32)
        return Level(np.hstack([w, old] if left else [old, w]), *((place, other) if left else (other, place)), count)

    def some(self, level: Level, keep: np.ndarray) -> Level:
        return Level(level.words[keep], level.forward[keep], level.reverse[keep], level.count[keep])


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, int]:
    """The distinct words (binary), the texts as numbers from 1 with 0 between pieces and at the end, and how many words."""
    words, owner, stops = C.split_words(texts, SPACE, STOP, lower=True)
    coded = words.dictionary_encode()
    n = len(words)
    # every text ends with a stop, so stops alone tell pieces apart
    gap = np.ones(n + 1, np.int64)
    gap[1:n] = stops[1:] != stops[:-1]
    gap[:1] = 0
    out = np.zeros(n + int(gap.sum()), np.int32)
    out[np.arange(n) + np.cumsum(gap)[:n]] = np.asarray(coded.indices, dtype=np.int32) + 1
    return coded.dictionary, out if n else np.zeros(1, np.int32), n


def _phrase_hash(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64-bit hash of each phrase from its words' hashes, the same in every shard."""
    h = np.full(len(words), np.uint64(words.shape[1]))
    for i in range(words.shape[1]):
        h = C.mix((h ^ hashes[words[:, i] - 1]) * np.uint64(0x9E3779B97F4A7C15))
    return h


def _word_hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in vocabulary), np.uint64, len(vocabulary))


INDEX = "lang string, n long, vocabulary binary, forward binary, reverse binary"
SUMS = "lang string, words int, phrase string, hash long, f long"


def index(docs: DataFrame, max_words: int, text_col: str, lang_col: str) -> DataFrame:
    """A row for each shard: its words and both transforms."""
    schema = C.arrow_schema(INDEX)

    def run(batches):
        for langs, texts in C.gathered(batches, SHARD_BYTES):
            for lang in pc.unique(langs):
                vocabulary, words, n = numbered(texts.filter(pc.equal(langs, lang)))
                if n:
                    built = Index.build(words, max_words)
                    row = {"lang": lang.as_py(), "n": n, "vocabulary": C.pack(b"\n".join(vocabulary.to_pylist())), "forward": C.pack(built.forward), "reverse": C.pack(built.reverse)}
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    return docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text_col].alias("text")).mapInArrow(run, INDEX)


def _send(lang: str, words: pa.Array, hashes: np.ndarray, level: Level, buckets: int):
    """A row for each bucket of a shard's phrases of one length."""
    h = _phrase_hash(hashes, level.words)
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    columns = [words.take(pa.array(level.words[order, i] - 1)) for i in range(level.words.shape[1])]
    phrases = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
    edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) > 0)[: len(order)])
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(edges, len(order)), pa.int64()), phrases)
    joined = pc.binary_join(lists, pa.scalar(b"\n", pa.large_binary())).to_pylist()
    counts = level.count[order]
    for i, (a, b) in enumerate(zip(edges, [*edges[1:], len(order)][: len(edges)], strict=True)):
        yield {"bucket": int(bucket[order[a]]), "lang": lang, "words": level.words.shape[1], "phrases": C.pack(joined[i]), "counts": C.pack(counts[a:b].astype(np.int64))}


SENT = "bucket long, lang string, words int, phrases binary, counts binary"


def _sum(least: int):
    out = C.arrow_schema(SUMS)

    def run(group: pa.Table) -> pa.Table:
        parts = {}
        for row in group.to_pylist():
            table = pa.table({"phrase": pa.array(C.unpack(row["phrases"]).split(b"\n"), pa.binary()), "f": C.unpack(row["counts"], np.int64)})
            parts.setdefault((row["lang"], row["words"]), []).append(table)
        found = []
        for (lang, size), tables in parts.items():
            total = pa.concat_tables(tables).group_by("phrase").aggregate([("f", "sum")])
            total = total.filter(pc.greater_equal(total.column("f_sum"), least)).combine_chunks()
            phrases, n = total.column("phrase").cast(pa.string()), len(total)
            coded = pa.concat_arrays([pc.list_flatten(pc.split_pattern(x, " ")) for x in phrases.chunks] or [pa.array([], pa.string())]).dictionary_encode()
            numbers = np.asarray(coded.indices, dtype=np.int64).reshape(n, size) + 1
            hashes = _phrase_hash(_word_hashes(lang, [w.encode() for w in coded.dictionary.to_pylist()]), numbers)
            found.append(pa.table([pa.array([lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)), phrases, pa.array(hashes.view(np.int64)), total.column("f_sum")], schema=out))
        return pa.concat_tables(found)

    return run


def frequent(docs: DataFrame, max_words: int, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f of every phrase of up to max_words words that occurs ``least`` times or more; lang, n)."""
    shards = C.cut(index(docs, max_words, text_col, lang_col))
    total = shards.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + total // BUCKET_WORDS
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    found, kept, sent = [], {}, C.arrow_schema(SENT)
    spark = docs.sparkSession
    for length in range(2, max_words + 1):
        shared = spark.sparkContext.broadcast(dict(kept))  # a bitmap of 2**BITMAP bits for each length

        def run(batches, length=length, shared=shared):
            maybe = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    vocabulary = C.unpack(row["vocabulary"]).split(b"\n")
                    words, hashes = pa.array(vocabulary, pa.large_binary()), _word_hashes(row["lang"], vocabulary)
                    shard = Index.of(C.unpack(row["forward"], np.int32), C.unpack(row["reverse"], np.int32))
                    level = shard.first()
                    rows = list(_send(row["lang"], words, hashes, level, buckets)) if length == 2 else []
                    for size in range(2, length + 1):
                        if size > 2:
                            level = shard.some(level, C.in_bitmap(maybe[size - 1], _phrase_hash(hashes, level.words).view(np.int64)))
                        level = shard.extend(level, left=size % 2 == 1)
                        if size > 2:
                            other = level.words[:, 1:] if size % 2 == 0 else level.words[:, :-1]
                            level = shard.some(level, C.in_bitmap(maybe[size - 1], _phrase_hash(hashes, other).view(np.int64)))
                    rows += _send(row["lang"], words, hashes, level, buckets)
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=sent)

        sums = C.cut(shards.select("lang", "vocabulary", "forward", "reverse").mapInArrow(run, SENT).groupBy("bucket").applyInArrow(_sum(least), SUMS))
        found.append(sums)
        if length < max_words:
            kept[length] = C.bitmap(sums.where(F.col("words") == length), "hash", BITMAP)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out, sizes


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, share: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per language the ``top`` phrases of 2 to max_words words by their weakest cut: lang, rank, phrase, a, l, r, n, score.

    Phrases inside a longer one that occurs at least share / 100 as often are left out.
    """
    counted, sizes = frequent(docs, max_words, least, text_col, lang_col)
    counted = counted.select("lang", "words", "phrase", "f")
    part = F.split("phrase", " ")
    cuts = counted.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(part, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(part, F.col("k") + 1, F.col("words")), " ").alias("rest"))
    known = lambda name, as_: counted.select("lang", F.col("phrase").alias(name), F.col("f").alias(as_))
    cuts = cuts.join(known("head", "l"), ["lang", "head"]).join(known("rest", "r"), ["lang", "rest"])
    wide = "cast({} as decimal(19,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div ({wide.format('l')} * {wide.format('r')})").alias("score")
    scored = cuts.select("lang", "words", "phrase", "a", "l", "r", "k", score)
    best = scored.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # what a longer phrase holds: its parts of 2 words and more
    inside = None
    for size in range(2, max_words):
        longer = counted.where(F.col("words") > size).select("lang", F.col("f").alias("outer"), F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: F.array_join(F.slice(part, i, F.lit(size)), " "))).alias("phrase"))
        inside = longer if inside is None else inside.union(longer)
    if inside is not None:
        inside = inside.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
        best = best.join(inside, ["lang", "phrase"], "left").where(F.col("outer").isNull() | (100 * F.col("outer") < share * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
