"""Spelling variant grouping: words one code point apart, found through pairs of trie nodes.

Words are sorted once from the front and once from the back.  In either order
the common beginnings of neighbours are the nodes of a trie; every node gets a
number, and a word becomes the numbers of its prefixes and of its suffixes.

Two words are one replaced code point apart if they skip a position between the
same prefix node and the same suffix node.  They are one inserted code point
apart if the shorter one has a gap where the longer one skips a position.  So a
word gives a row (prefix node, suffix node) for each position it skips and each
gap, and words meet on equal integer pairs: no strings are compared, nothing is
hashed, and no neighbour is missed or invented.  A node that only one word has
cannot be in a pair that two words share, so such rows are never made.

One pair of nodes holds at most one word without a position between them and one
for each letter, at most 91 rows, whatever the corpus.  A run of equal letters
can be skipped at any of its positions; insertions count at its last one only.

Numbering: the words are range partitioned and written with their partition.  A
node whose words lie in two partitions is a common beginning of the last word of
one and the first word of the next.  The driver numbers just these, from two
words a range partition; all others are numbered inside their partition.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .arrow import column, groups, slices, text_view

#: Fixed values of the contract: which runs lose a code point, shortest word, least count, how much commoner a form is.
ALTERED, MIN_CHARS, MIN_COUNT, COMMONER = 199, 6, 5, 5
#: Distinct words a task holds before it passes its counts on.
HELD_WORDS = 1 << 20
#: A form is at least COMMONER times as frequent as its word, so a chain of forms has at most 27 steps and doubling ends after 5 rounds.
ROUNDS = 5
_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = _LETTER[0xC3] = True  # U+00C0 to U+00FF are 0xC3 and one byte more
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ALL = 0xFFFFFFFF


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of all texts, with A-Z lower-cased, and the text of each."""
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == 0xC3
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = letter.copy(), letter.copy()
    start[1:] &= ~letter[:-1] | edge[1:-1]
    end[:-1] &= ~letter[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    sizes = np.flatnonzero(end) + 1 - starts
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    letters = np.ascontiguousarray(_LOWER[data[letter]])
    runs = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return runs, np.searchsorted(offsets, starts, "right") - 1


def _digests(ids: list[bytes], doc: np.ndarray, words: list[bytes], word: np.ndarray) -> np.ndarray:
    """crc32 of ``<id>:<word>`` for every occurrence.

    A crc of two joined strings is the first one's, carried over as many zero bytes as the second has, xor the
    second one's; so each distinct word and each (id, length) is worked out once.
    """
    if not len(word):
        return np.zeros(0, np.int64)
    size = np.array([len(w) for w in words], np.int64)
    own = np.array([zlib.crc32(w, _ALL) ^ _ALL for w in words], np.int64)
    span = int(size.max()) + 1
    pairs, back = np.unique(doc * span + size[word], return_inverse=True)
    zeros, before = memoryview(bytes(span)), [zlib.crc32(i + b":") for i in ids]
    carried = np.array([zlib.crc32(zeros[:k % span], before[k // span]) for k in pairs.tolist()], np.int64)
    return carried[back] ^ own[word]


def _counted(ids: list[bytes], data: np.ndarray, offsets: np.ndarray) -> pa.Table:
    """Words of a slice, altered where their digest says so, with their counts."""
    runs, doc = letter_runs(data, offsets)
    coded = runs.dictionary_encode()
    word, found = coded.indices.to_numpy(), coded.dictionary
    digest = _digests(ids, doc, found.cast(pa.large_binary()).to_pylist(), word)
    hit = digest % ALTERED == 0
    counts = np.bincount(word[~hit], minlength=len(found))
    keep = (counts > 0) & (pc.utf8_length(found).to_numpy() >= MIN_CHARS)
    changed: Counter[str] = Counter()
    for w, h in zip(found.take(pa.array(word[hit])).to_pylist(), digest[hit].tolist(), strict=True):
        if len(w) > MIN_CHARS:
            at = h % len(w)
            changed[w[:at] + w[at + 1:]] += 1
    return pa.table({
        "word": pa.concat_arrays([found.filter(pa.array(keep)), pa.array(changed.keys(), pa.large_string())]),
        "n": pa.concat_arrays([pa.array(counts[keep], pa.int64()), pa.array(changed.values(), pa.int64())])})


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: all words of at least MIN_CHARS code points and MIN_COUNT occurrences in ``docs`` (doc_id, text).

    A null text has no words; a null id counts as an empty string in the digest.  Repeated rows count each time.
    Tasks add up what they hold before it is shuffled.
    """
    kept = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, least = [], 0, HELD_WORDS
        for batch in batches:
            for part in slices(batch, "text"):
                ids = column(part, "id").cast(pa.binary()).to_pylist()
                held.append(_counted(ids, *text_view(column(part, "text"))))
                size += held[-1].num_rows
                if size >= least:
                    held = [added(held)]
                    size = held[0].num_rows
                    if size >= HELD_WORDS:
                        yield from held[0].cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)
                        held, size = [], 0
                    least = max(HELD_WORDS, 2 * size)
        if held:
            yield from added(held).cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)

    return kept.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _borders(edges: list[tuple[int, str, str]]) -> dict[int, tuple[tuple[str, list[int]], tuple[str, list[int]]]]:
    """For each partition what its first word shares with the word before, its last word with the word after, and the
    numbers of these nodes: -1, -2, ... in their order.  ``edges``: (partition, first word, last word), in order."""
    shared: list[tuple[str, list[int]]] = [("", [])]
    fresh = 0
    for (_, _, last), (_, first, _) in zip(edges, edges[1:], strict=False):
        text = last[:_common(last, first)]
        before, numbers = shared[-1]
        own = numbers[:_common(before, text)]
        while len(own) < len(text):
            fresh += 1
            own.append(-fresh)
        shared.append((text, own))
    shared.append(("", []))
    return {p: (shared[i], shared[i + 1]) for i, (p, *_) in enumerate(edges)}


def _numbered(words: list[str], part: int, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> Iterator[list[int]]:
    """For each word of a partition, in order: the numbers of the prefixes that it shares with another word (from the root, 0)."""
    base, fresh = part << 40, 0
    same = [len(left[0]), *[_common(a, b) for a, b in zip(words, words[1:], strict=False)], len(right[0])]
    stack, depth = [0], 0
    for k, word in enumerate(words):
        depth = min(same[k], depth)  # the stack holds as much of the word before as that word shared
        del stack[depth + 1:]
        want = max(same[k], same[k + 1])
        if depth < want:
            of_left, of_right = _common(word, left[0]), _common(word, right[0])
            for d in range(depth + 1, want + 1):
                if d <= of_left:
                    stack.append(left[1][d - 1])
                elif d <= of_right:
                    stack.append(right[1][d - 1])
                else:
                    fresh += 1
                    stack.append(base + fresh)
            depth = want
        yield stack[:want + 1]


def trie_nodes(words: DataFrame, backwards: bool = False) -> DataFrame:
    """``(word, n, number, nodes)``: the numbers of the prefixes (suffixes) that a word shares with another, shortest first.

    ``number`` follows the order of the words, by code points (of their reversals, if ``backwards``).
    """
    key = F.reverse("word") if backwards else F.col("word")
    ordered = materialize(words.select("word", "n", key.alias("key")).repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ordered")
    edges = [tuple(r) for r in ordered.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()]  # one row a range partition
    borders = _borders(edges)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["part"]):
            part = group["part"][0].as_py()
            lists = list(_numbered(group["key"].to_pylist(), part, *borders[part]))
            at = np.arange(len(lists))
            for k in range(0, len(lists), 1 << 14):
                own = slice(k, k + (1 << 14))
                rows = group.slice(k, 1 << 14).select(["word", "n"]).combine_chunks()
                rows = rows.append_column("number", pa.array((part << 40) + at[own])).append_column("nodes", pa.array(lists[own], pa.list_(pa.int64())))
                yield from rows.to_batches()

    return (ordered.repartition("part").sortWithinPartitions("part", "key")
            .mapInArrow(number, "word string, n long, number long, nodes array<long>"))


def _list(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = column(batch, name)
    first = values.offsets.to_numpy().astype(np.int64)
    return values.values.to_numpy(), first[:-1], np.diff(first)


def _runs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of all low[r] <= value <= high[r]."""
    count = np.maximum(high - low + 1, 0)
    row = np.repeat(np.arange(len(low)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]


GAP, SKIP, SKIP_LAST = 0, 1, 2


def node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix node, suffix node, number, n, kind) of words: gaps, skipped positions, the latter also as last of equal letters."""
    for batch in batches:
        words = column(batch, "word").to_pylist()
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        length = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(length) - length
        prefix, first_p, n_p = _list(batch, "prefixes")
        suffix, first_s, n_s = _list(batch, "suffixes")
        numbers, n = column(batch, "number").to_numpy(), column(batch, "n").to_numpy()
        row, i = _runs(np.maximum(0, length - n_s), np.minimum(length, n_p) - 1)
        rest = length[row] - 1 - i
        char = begin[row] + i
        last = (rest == 0) | (chars[char] != np.append(chars, 0)[char + 1])
        gap, g = _runs(np.maximum(0, length - n_s + 1), np.minimum(length, n_p - 1))
        rows = np.concatenate([row, gap])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([prefix[first_p[row] + i], prefix[first_p[gap] + g]])),
             pa.array(np.concatenate([suffix[first_s[row] + rest], suffix[first_s[gap] + length[gap] - g]])),
             pa.array(numbers[rows]), pa.array(n[rows]),
             pa.array(np.concatenate([np.where(last, SKIP_LAST, SKIP), np.full(len(gap), GAP)]).astype(np.int8))],
            names=["p", "s", "number", "n", "kind"])


def _first(group: np.ndarray, some: np.ndarray, total: int) -> np.ndarray:
    """Place of the first row of each group among ``some``; -1 where it has none."""
    out = np.full(total, -1)
    at = np.flatnonzero(some)[::-1]
    out[group[at]] = at
    return out


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words that meet in a pair of nodes: for each word their number and the most frequent one.

    Batches are sorted by (p, s) and then by frequency, most frequent first, equal ones by word.
    """
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        now = {k: column(batch, k).to_numpy() for k in ("p", "s", "number", "n", "kind")}
        if held is not None:
            now = {k: np.concatenate([held[k], v]) for k, v in now.items()}
        if not len(now["p"]):
            continue
        new = np.flatnonzero((now["p"][1:] != now["p"][:-1]) | (now["s"][1:] != now["s"][:-1])) + 1
        cut = int(new[-1]) if len(new) else 0
        held = {k: v[cut:] for k, v in now.items()}
        if cut:
            yield _met({k: v[:cut] for k, v in now.items()})
    if held is not None:
        yield _met(held)


def _met(x: dict[str, np.ndarray]) -> pa.RecordBatch:
    size = len(x["p"])
    new = np.ones(size, bool)
    new[1:] = (x["p"][1:] != x["p"][:-1]) | (x["s"][1:] != x["s"][:-1])
    group = np.cumsum(new) - 1
    total = int(group[-1]) + 1
    skip, last, gap = x["kind"] != GAP, x["kind"] == SKIP_LAST, x["kind"] == GAP
    skips, lasts, gaps = (np.bincount(group[some], minlength=total) for some in (skip, last, gap))
    one = _first(group, skip, total)
    others = skip.copy()
    others[one[one >= 0]] = False
    two = _first(group, others, total)
    at = np.arange(size)
    near = np.where(gap, lasts[group], skips[group] - 1 + np.where(last, gaps[group], 0))
    best = np.where(gap, _first(group, last, total)[group], np.where(one[group] == at, two[group], one[group]))
    with_gap = np.where(last, _first(group, gap, total)[group], -1)
    best = np.where((with_gap >= 0) & ((best < 0) | (with_gap < best)), with_gap, best)  # rows of a group are in order of frequency
    some = near > 0
    best = best[some]
    return pa.RecordBatch.from_arrays([pa.array(x["number"][some]), pa.array(near[some].astype(np.int64)), pa.array(x["n"][best]), pa.array(x["number"][best])],
                                      names=["number", "near", "best_n", "best"])


def spelling_variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``words`` (word, n; distinct words).

    ``n_near``: words one inserted, deleted or replaced code point away.  ``form``: the one with the largest n (ties:
    smallest by code points) if that n is at least COMMONER times the word's, else null.  ``root``: the end of the
    chain of forms, the word itself if it has none.
    """
    words = materialize(words.select("word", "n"), "words")
    front, back = trie_nodes(words), trie_nodes(words, backwards=True)
    both = front.withColumnRenamed("nodes", "prefixes").join(back.select("word", F.col("nodes").alias("suffixes")), "word")
    both = materialize(both, "nodes")
    pairs = both.mapInArrow(node_pairs, "p long, s long, number long, n long, kind byte")
    met = (pairs.repartition("p", "s").sortWithinPartitions("p", "s", F.desc("n"), "number")
           .mapInArrow(meet, "number long, near long, best_n long, best long"))
    near = met.groupBy("number").agg(F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("down"))).alias("top"))
    formed = both.select("word", "n", "number").join(near, "number", "left").select(
        "word", "n", "number", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("top.best_n") >= COMMONER * F.col("n"), F.struct((-F.col("top.down")).alias("number"), F.col("top.best_n").alias("n"))).alias("form"))
    formed = materialize(formed, "forms")
    roots = _roots(formed.where(F.col("form").isNotNull()).select("number", F.col("form.number").alias("root")))
    name = formed.select(F.col("number").alias("root"), F.col("word").alias("root_word"))
    form_name = formed.select(F.col("number").alias("form_number"), F.col("word").alias("form_word"))
    chained = roots.join(name, "root").select("number", "root_word")
    return (formed.join(chained, "number", "left").withColumn("form_number", F.col("form.number")).join(form_name, "form_number", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.col("form.n").alias("form_n")))


def _roots(links: DataFrame) -> DataFrame:
    """Ends of all chains of ``(number, root)`` by pointer doubling; each round is written."""
    links = materialize(links, "chains")
    for _ in range(ROUNDS):
        onward = links.select(F.col("number").alias("root"), F.col("root").alias("onward"))
        seen = Observation()
        links = materialize(links.join(onward, "root", "left").observe(seen, F.count("onward").alias("moved"))
                            .select("number", F.coalesce("onward", "root").alias("root")), "chains")
        if not seen.get["moved"]:
            break
    return links


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all texts: ``word_counts`` and ``spelling_variants``; no rows for an empty table."""
    return spelling_variants(word_counts(docs))
