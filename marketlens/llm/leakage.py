"""Problem 7: evaluation texts that leaked into training texts.

Training suffix arrays. Every task builds a suffix array (prefix doubling over word ids) over each bounded shard of its
documents, with the common prefixes of neighbouring suffixes. Every suffix of every test item is binary-searched in every
shard; the common prefixes around the place where it belongs give all places it matches verbatim, and how far. A document
that holds enough words of an item in one verbatim match is a leak by that alone. Where the matches are shorter, an
alignment of the item with the document around them follows, so that a word changed now and then, or a passage in
pieces, doesn't hide a leak, and a sentence that merely shares its wording isn't one.

Which lines are instructions and which words are wording is counted over all test items before these are cut into
blocks, so that results don't depend on the size of a block.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import spread, written

SEED = 5
"""Words of the shortest verbatim match that is looked for."""
LEAST_VERBATIM = 7
"""Words of an item that must match verbatim in a document, in matches of SEED words or more, for the two to be aligned."""
LEAST_WORDS = 16
"""Words of the item that a document must hold, in one verbatim match or in solid passages."""
PASSAGE, SOLID, SPECIFIC, GAP = 7, 0.75, 0.65, 2
"""A passage: at least so many words, this share of them matched, this share of the item's own words matched, no longer gap."""
SHARD_WORDS = 1 << 20
BLOCK_CHARS = 8 << 20
"""Test text that is searched for at once; more text is searched for block by block in the corpus's word ids, written once."""
CACHED_WORDS = 1 << 20

_LOOKALIKE = str.maketrans(
    "аеорсухіјѕԁкмтнвАВЕКМНОРСТУХІЈЅαοερνικτΑΒΕΗΙΚΜΝΟΡΤΧΥΖ",
    "aeopcyxijsdkmthbABEKMHOPCTYXIJSaoepviktABEHIKMNOPTXYZ",
)  # fixed values: Cyrillic and Greek letters that look like Latin ones
_TAG, _WORD = re.compile(r"</?[A-Za-z][^<>]{0,200}>"), re.compile(r"[^\W_]+")
_UNSEEN = regex.compile(r"[\p{Mn}\p{Cf}]+")
_SENTENCE = re.compile(r"[.?!;:\n]+")
_PLAIN = re.compile(r"[a-z0-9]+")


def bare(text: str) -> str:
    """A text in lower case without markup, entities, marks, width, look-alike letters and soft hyphens."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text).translate(_LOOKALIKE))
    return text.lower()


def words(text: str | None) -> list[str]:
    """The words of a text without case, punctuation and what ``bare`` takes off."""
    return _WORD.findall(bare(text)) if text else []


def plain_words(text: str | None) -> list[str]:
    """Runs of ASCII letters and digits in lower case, and nothing else done."""
    return _PLAIN.findall(text.lower()) if text else []


def _hashed(tokens: list[str], known: dict[str, int]) -> list[int]:
    """Words as 64-bit hashes; ``known`` remembers them."""
    if len(known) > CACHED_WORDS:
        known.clear()
    for w in set(tokens).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w) - (1 << 63)
    return [known[w] for w in tokens]


class SuffixArray:
    """The suffixes of a text of word ids in order; a suffix ends before the next 0, an unknown word.

    Prefix doubling: suffixes in order of their first h words are put in order of 2h, looking only at those not told
    apart yet, until ``reach`` words are compared. The ranks of each step are kept: from the longest step down they
    tell how many words any two suffixes have in common. ``order`` holds the suffixes of ``least`` words or more,
    ``common`` of each the words it shares with the one before it.
    """

    def __init__(self, text: np.ndarray, least: int, reach: int) -> None:
        n = len(text)
        self.text, self.least, self.reach = np.append(text, 0), least, reach
        ends = np.flatnonzero(self.text == 0)
        self.run = np.append(ends[np.searchsorted(ends, np.arange(n))] - np.arange(n), 0)
        order = np.flatnonzero(self.text)
        order = order[np.argsort(self.text[order], kind="stable")]
        fresh = np.append(True, np.diff(self.text[order]) != 0)[: len(order)]
        h, rank = 1, self._ranks(np.zeros(n + 1, np.int32), order, fresh)
        self.steps = [(h, rank)]
        while h < reach:
            first = np.flatnonzero(fresh)
            size = np.diff(np.append(first, len(order)))
            tied = np.flatnonzero(np.repeat(size > 1, size))
            if not len(tied):
                break
            part = order[tied]
            key = rank[part].astype(np.int64) << 32 | np.where(self.run[part] > h, rank[np.minimum(part + h, n)], 0)
            by_key = np.argsort(key, kind="stable")
            order[tied], key = part[by_key], key[by_key]
            fresh[tied] = np.append(True, np.diff(key) != 0)
            h, rank = 2 * h, self._ranks(rank.copy(), order, fresh)
            self.steps.append((h, rank))
        self.order = order[self.run[order] >= least]
        self.common = np.append(0, self.shared(self.order[:-1], self.order[1:]))[: len(self.order)]

    @staticmethod
    def _ranks(rank: np.ndarray, order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(fresh)
        rank[order] = np.repeat(first, np.diff(np.append(first, len(order)))) + 1
        return rank

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` begin with alike."""
        n, total = len(self.text) - 1, np.zeros(len(a), np.int64)
        for h, rank in reversed(self.steps):
            total += h * (rank[np.minimum(a + total, n)] == rank[np.minimum(b + total, n)])
        return np.minimum(total, np.minimum(self.run[a], self.run[b]))

    def find(self, ids: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Binary search of the suffixes of ``ids`` at ``query`` (each ends at a -1): the rank where each belongs, and the words it shares with the suffix before and with that at the rank."""
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(self.order))
        before, after = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            at, wanted, k = self.order[middle], query[open_], np.minimum(before[open_], after[open_])
            live = np.arange(len(open_))
            while len(live):
                live = live[self.text[at[live] + k[live]] == ids[wanted[live] + k[live]]]
                k[live] += 1
            less = self.text[at + k] < ids[wanted + k]
            low[open_[less]], before[open_[less]] = middle[less] + 1, k[less]
            high[open_[~less]], after[open_[~less]] = middle[~less], k[~less]
        return low, before, after

    def matches(self, ids: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every place where ``least`` words or more of a suffix of ``ids`` at ``query`` stand: places, suffixes, and words that match."""
        at, before, after = self.find(ids, query)
        first = np.flatnonzero(self.common < self.least)  # suffixes with ``least`` words in common are neighbours
        last = np.append(first[1:], len(self.order))
        hit = np.flatnonzero(np.maximum(before, after) >= self.least)
        at, before, after, query = at[hit], before[hit], after[hit], query[hit]
        group = np.searchsorted(first, np.where(after >= self.least, at, at - 1), "right") - 1
        parts = []
        for up in (True, False):
            many = last[group] - at if up else at - first[group]
            who = np.repeat(np.arange(len(at)), many)
            step = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
            rank = at[who] + step if up else at[who] - 1 - step
            near = np.where(step == 0, (after if up else before)[who], self.common[np.minimum(rank if up else rank + 1, len(self.order) - 1)])
            # the least so far, by item suffix: later ones are lifted below all before
            lift = (len(at) - 1 - who) * (int(near.max(initial=0)) + 1)
            parts.append((self.order[rank], query[who], np.minimum.accumulate(near + lift) - lift))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class TestItems:
    """The test items of one block: word ids (each item ends with -1), which words count, and which are an item's own."""

    def __init__(self, lines: list[tuple[int, int, list[str], bool]], common: set[str], least: int) -> None:
        """``lines``: item, its text, the words of a line, whether the line is shared; in order."""
        known, self.item_ids, self.starts, last = {}, [], [], None
        hashes, inside, counts, own = [], [], [], []

        def close() -> None:
            if self.item_ids:
                for values, end in ((hashes, 0), (inside, False), (counts, False), (own, False)):
                    values.append(end)

        for item_id, text, tokens, shared in lines:
            if (item_id, text) != last:
                close()
                last = item_id, text
                self.item_ids.append(item_id)
                self.starts.append(len(hashes))
            hashes += _hashed(tokens, known)
            inside += [True] * len(tokens)
            counts += [not shared] * len(tokens)
            own += [w not in common for w in tokens]
        close()
        self.starts.append(len(hashes))
        ids, inside = np.array(hashes, np.int64), np.array(inside, bool)
        self.counts, self.own = np.array(counts, bool), np.array(own, bool)
        self.vocabulary = np.unique(ids[inside])
        self.ids = np.where(inside, np.searchsorted(self.vocabulary, ids) + 1, -1)
        self.item_of = np.repeat(np.arange(len(self.item_ids)), np.diff(self.starts))
        self.least, self.reach = least, int(np.diff(self.starts).max(initial=1))
        self.searched = np.lib.stride_tricks.sliding_window_view(np.append(self.counts, np.zeros(least - 1, bool)), least).all(1) if len(ids) else inside
        self.suffixes = np.flatnonzero(self.searched)

    def __len__(self) -> int:
        return len(self.item_ids)

    def end(self, item: int) -> int:
        return self.starts[item + 1] - 1

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids of hashed words, 0 for words that no item of the block has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The verbatim matches of ``least`` words or more that can't be prolonged: place in ``text``, place in the items, words."""
        none = np.zeros(0, np.int64)
        if not len(self.suffixes):
            return none, none, none
        array = SuffixArray(text, self.least, self.reach)
        if not len(array.order):
            return none, none, none
        place, query, length = array.matches(self.ids, self.suffixes)
        text = array.text
        # the match of a suffix that begins a word later is part of this one
        starts = ~(self.searched[query - 1] & (query > 0) & (text[place - 1] == self.ids[query - 1]))
        place, query, length = place[starts], query[starts], length[starts]
        live = np.arange(len(place))
        while len(live):  # to the left, over words that don't count
            live = live[(place[live] > 0) & (query[live] > 0)]
            live = live[text[place[live] - 1] == self.ids[query[live] - 1]]
            place[live] -= 1
            query[live] -= 1
            length[live] += 1
        return place, query, length

    def solid(self, item: int, matched: np.ndarray) -> list[slice]:
        """The solid passages among the matched words of an item, as spans of it."""
        mine, out = self.own[self.starts[item] : self.end(item)], []
        hits = np.flatnonzero(matched)
        for part in np.split(hits, np.flatnonzero(np.diff(hits) > GAP + 1) + 1):
            if len(part):
                span = slice(part[0], part[-1] + 1)
                own = mine[span]
                if part[-1] + 1 - part[0] >= PASSAGE and matched[span].mean() >= SOLID and (not own.any() or matched[span][own].mean() >= SPECIFIC):
                    out.append(span)
        return out

    def held(self, text: np.ndarray, first: int, last: int, item: int, place: np.ndarray, query: np.ndarray, length: np.ndarray) -> int:
        """The item's words that one document (text[first:last]) holds in solid passages.

        An alignment keeps the order of the item. Passages in another order are found by aligning again what is left
        of the item, around the matches there, with what is left of the document, as long as that adds a passage.
        """
        start, end = self.starts[item], self.end(item)
        item_ids, size = self.ids[start:end], end - start
        many = length - self.least + 1
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at, query = np.repeat(place, many) + step, np.repeat(query, many) + step  # every ``least`` words that match
        order = np.argsort(at - (query - start), kind="stable")
        at, query = at[order], query[order] - start
        cuts = np.flatnonzero(np.diff(at - query) > 8) + 1
        taken, used = np.zeros(size, bool), np.zeros(last - first, bool)  # words in solid passages, of the item and of the document
        solid = np.zeros(size, bool)

        def align(a: int, b: int, low: int, high: int, rest: bool) -> bool:
            """Aligns item[a:b] with text[low:high]; if ``rest``, without the words in passages so far. Tells whether it adds a passage."""
            low, high = max(first, low), min(last, high)
            mine, theirs = item_ids[a:b], text[low:high]
            if rest:  # two values that agree with nothing
                mine, theirs = np.where(taken[a:b], -1, mine), np.where(used[low - first : high - first], -2, theirs)
            matched, place = np.zeros(size, bool), np.zeros(size, np.int64)
            for i, j, n in SequenceMatcher(None, mine.tolist(), theirs.tolist(), autojunk=False).get_matching_blocks():
                matched[a + i : a + i + n] = True
                place[a + i : a + i + n] = np.arange(low + j - first, low + j - first + n)
            spans = self.solid(item, matched)
            for span in spans:
                solid[span] |= matched[span]
                taken[span] = True
                used[place[span][matched[span]]] = True
            return bool(spans)

        clusters = list(zip(np.split(at, cuts), np.split(query, cuts), strict=True))
        for places, words_at in clusters:
            diagonals = places - words_at
            align(0, size, int(diagonals[0]) - 8, int(diagonals[-1]) + size + 8, False)
        for places, words_at in clusters:
            more = True
            while more:
                more = False
                left = ~(taken[words_at] | taken[words_at + self.least - 1] | used[places - first] | used[places - first + self.least - 1])
                edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    here = left & (words_at >= a) & (words_at + self.least <= b)
                    if b - a >= PASSAGE and here.any():
                        diagonals = (places - words_at)[here]
                        more |= align(a, b, int(diagonals.min()) + a - 8, int(diagonals.max()) + b + 8, True)
        return int((solid & self.counts[start:end]).sum())


def _pairs(items: TestItems, ids: list[int], texts: list[np.ndarray]) -> Iterator[tuple]:
    """For each document of a shard and item with verbatim matches: both, the shard's text, the document's span, and the matches."""
    lengths = np.array([len(t) for t in texts], np.int64)
    text = np.zeros(lengths.sum() + len(texts), np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    for s, t in zip(starts, texts, strict=True):
        text[s : s + len(t)] = items.encode(t)
    place, query, length = items.search(text)
    if not len(place):
        return
    doc = np.searchsorted(starts, place, "right") - 1
    pair = doc * len(items) + items.item_of[query]
    order = np.argsort(pair, kind="stable")
    pair, place, query, length = pair[order], place[order], query[order], length[order]
    cuts = np.flatnonzero(np.diff(pair)) + 1
    for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(pair)).tolist(), strict=True):
        d, i = divmod(int(pair[a]), len(items))
        yield ids[d], i, text, int(starts[d]), int(starts[d] + lengths[d]), place[a:b], query[a:b], length[a:b]


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


_LEAK = ["doc_id", "item_id", "words", "longest", "place", "verbatim"]
_COPY = ["doc_id", "item_id", "starts", "longest"]


def _leaked(items: TestItems, ids: list[int], texts: list[np.ndarray], least_words: int, least_verbatim: int) -> pa.RecordBatch:
    rows = []
    for doc_id, i, text, first, last, place, query, length in _pairs(items, ids, texts):
        if length.sum() < least_verbatim:
            continue
        start, end = items.starts[i], items.end(i)
        counts, covered, passages, best = items.counts[start:end], np.zeros(end - start, bool), np.zeros(end - start, bool), 0
        for q, n in zip((query - start).tolist(), length.tolist(), strict=True):
            covered[q : q + n] = True
            if n >= PASSAGE:
                passages[q : q + n] = True
                best = max(best, int(counts[q : q + n].sum()))
        verbatim = int((passages & counts).sum())
        if covered.sum() < least_verbatim:
            continue
        held = verbatim if covered.all() and best >= least_words else max(best if best >= least_words else 0, items.held(text, first, last, i, place, query, length))
        if held >= least_words:
            longest = int(length.max())
            rows.append((doc_id, items.item_ids[i], held, longest, int(place[length == longest].min()) - first, verbatim))
    return _batch(rows, _LEAK)


def _copied(items: TestItems, ids: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
    rows = []
    for doc_id, i, _, _, _, _, query, length in _pairs(items, ids, texts):
        begins = np.zeros(items.end(i) - items.starts[i], bool)
        for q, n in zip((query - items.starts[i]).tolist(), length.tolist(), strict=True):
            begins[q : q + n - items.least + 1] = True
        rows.append((doc_id, items.item_ids[i], int(begins.sum()), int(length.max())))
    return _batch(rows, _COPY)


def item_lines(benchmark: DataFrame, tokenise: Callable[[str], list[str]], by_line: bool) -> DataFrame:
    """``item_id, part, line_no, line``: the words of the lines of every test item; ``part`` tells different texts of one item apart."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item_id, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for n, line in enumerate(_SENTENCE.split(text) if by_line else (text,)):
                    if found := tokenise(line):
                        rows.append((item_id, part, n, " ".join(found)))
            ids, parts, numbers, lines = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lines, pa.string())], ["item_id", "part", "line_no", "line"])

    texts = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.xxhash64("text").alias("part"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    return texts.distinct().mapInArrow(split, "item_id bigint, part bigint, line_no int, line string")


def _blocks(lines: DataFrame, common: set[str], least: int, block_chars: int) -> Iterator[TestItems]:
    """The test items in blocks of about ``block_chars`` characters; an item is never cut."""
    chars = lines.agg(F.coalesce(F.sum(F.length("line") + 1), F.lit(0))).first()[0]
    blocks = chars // block_chars + 1
    place = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for b in range(blocks):
        found = lines.where(place == b).orderBy("item_id", "part", "line_no").collect()
        yield TestItems([(r["item_id"], r["part"], r["line"].split(" "), r["shared"]) for r in found], common, least)


def _search(docs: DataFrame, blocks: Iterator[TestItems], several: bool, tokenise: Callable[[str], list[str]], rows: Callable, names: list[str]) -> DataFrame:
    """``rows`` of every shard of documents and block of items; with ``several`` blocks the corpus is tokenised once, into a written table of word ids."""
    spark = docs.sparkSession
    slim = spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            tokens = [_hashed(tokenise(t), known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.list_(pa.int64()))], ["doc_id", "ids"])

    def searching(items, source: Callable) -> Callable:  # noqa: ANN001
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, texts, size = [], [], 0
            for batch in source(batches):
                column = batch.column(1)
                flat, cuts = column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
                for k, doc_id in enumerate(batch.column(0).to_pylist()):
                    ids.append(doc_id)
                    texts.append(flat[cuts[k] : cuts[k + 1]])
                    size += len(texts[-1])
                    if size >= SHARD_WORDS:
                        yield rows(items.value, ids, texts)
                        ids, texts, size = [], [], 0
            yield rows(items.value, ids, texts)

        return scan

    schema = ", ".join(f"{n} bigint" for n in names)
    if several:
        slim = written(slim.mapInArrow(hashed, "doc_id bigint, ids array<bigint>"), "words")
    source = iter if several else hashed
    # one block is at most about BLOCK_CHARS of text, or one item
    parts = [slim.mapInArrow(searching(spark.sparkContext.broadcast(items), source), schema) for items in blocks]
    return reduce(DataFrame.unionByName, parts)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    shared_items: int = 3,
    common_percent: int = 5,
    least_words: int = LEAST_WORDS,
    least_verbatim: int = LEAST_VERBATIM,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, words, longest, place, verbatim, found_by``: every document that holds ``least_words`` words or more of a test item.

    ``words``: the item's words held, in one verbatim match or in solid passages; ``longest``: words of the longest
    verbatim match, ``place`` the word of the document where it starts; ``verbatim``: the item's words in verbatim
    matches of PASSAGE words or more; ``found_by``: ``suffix array`` where these are ``least_words`` or more, else
    ``alignment``. A sentence that ``shared_items`` items or more of the benchmark have in common is an
    instruction and doesn't count. A word that over ``common_percent`` % of all items have is wording; the others are an
    item's own, and must mostly be there too. Null or empty texts hold nothing; repeated rows of a document or an item
    count once; empty tables give no rows.
    """
    lines = written(item_lines(benchmark, words, True), "lines")
    n_items = lines.select("item_id").distinct().count()
    seen = lines.select("item_id", F.explode(F.split("line", " ")).alias("word")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # words that 5 % of the items have: at most 20 times as many as a mean item has words
    common = {r["word"] for r in seen.where(F.col("n") > max(2.0, common_percent * n_items / 100)).select("word").collect()}
    shared = lines.select("item_id", "line").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= shared_items).select("line", F.lit(True).alias("shared"))
    lines = lines.join(shared, "line", "left").na.fill({"shared": False})
    several = lines.agg(F.coalesce(F.sum(F.length("line") + 1), F.lit(0))).first()[0] >= block_chars

    def rows(items: TestItems, ids: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
        return _leaked(items, ids, texts, least_words, least_verbatim)

    found = _search(docs, _blocks(lines, common, SEED, block_chars), several, words, rows, _LEAK)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("words", "longest", F.negative("place").alias("back"), "verbatim")).alias("_m"))
    by = F.when(F.col("_m.verbatim") >= least_words, "suffix array").otherwise("alignment")
    return best.select("doc_id", "item_id", "_m.words", "_m.longest", F.negative("_m.back").alias("place"), "_m.verbatim", by.alias("found_by"))


def verbatim_copies(docs: DataFrame, benchmark: DataFrame, least: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, starts, longest``: documents that hold ``least`` words or more of an item's ``plain_words`` in a row.

    By the suffix arrays alone: ``starts`` are the words of the item at which such a match begins, ``longest`` the words
    of the longest match. Nulls, repeats and empty tables as in ``leaks``.
    """
    lines = item_lines(benchmark, plain_words, False).withColumn("shared", F.lit(False))
    several = lines.agg(F.coalesce(F.sum(F.length("line") + 1), F.lit(0))).first()[0] >= block_chars
    found = _search(docs, _blocks(lines, set(), least, block_chars), several, plain_words, _copied, _COPY)
    return found.groupBy("doc_id", "item_id").agg(F.max("starts").alias("starts"), F.max("longest").alias("longest"))


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that hold no test item; rows with a null id can't be found and stay."""
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
