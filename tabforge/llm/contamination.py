"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

The words of all items go into one suffix automaton. Documents are streamed through it: the automaton
keeps the longest stretch of words, ending at the current one, that stands in some item. A window of an
item is 13 consecutive words; an item of fewer words, but not none, is one window. Words inside any
occurrence of a window are hit.

Most document words cannot be part of a match, which arrays find out for whole slices of texts: a match
of n words consists of n - 1 neighbouring pairs that stand in items. Only runs of such pairs enter the
automaton, which works on the exact words, so no hash collision can make a hit.

Items go in blocks of bounded size; each block is one automaton and one pass over the documents, so the
automaton that tasks hold does not grow with the benchmark. Long items are cut into pieces that overlap by a
window less one word, which keeps every window.

Documents of which a twentieth is hit go as a whole. Out of the others the hit stretches beyond stated limits are cut.
"""

from __future__ import annotations

import pickle
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .words import Words, flat, gram, slices, unused, words_of

WINDOW = 13
BLOCK_WORDS = 60_000
PIECE_WORDS = 20_000
# Hit stretches of more words go, and all of a text's from this share of its words on
MOST_WORDS = 0
SHARE = 0.05
SPAN = "array<struct<start:long,stop:long>>"


class Automaton:
    """``pieces``: (item, words) pairs. Holds which windows end where in the automaton."""

    def __init__(self, pieces: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.code: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.depth = [-1], [0]
        ends: dict[int, list[str]] = {}
        self.short: dict[int, tuple[int, list[str]]] = {}
        coded = [(item, [self.code.setdefault(w.encode(), len(self.code)) for w in words]) for item, words in pieces]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # every position of an item, as the state that its prefix leads to
        for item, codes in coded:
            state, length = 0, 0
            for c in codes:
                state, length = self.next[state][c], length + 1
                while self.depth[self.link[state]] >= length > 0:
                    state = self.link[state]
                if length >= window:
                    state, length = self._cut(state, window)
                    ends.setdefault(state, []).append(item)
            if 0 < len(codes) < window:
                self.short.setdefault(state, (length, []))[1].append(item)
        self.items = {state: sorted(set(v)) for state, v in ends.items()}
        self.short = {state: (n, sorted(set(v))) for state, (n, v) in self.short.items()}
        self.least = min((min(len(c), window) for _, c in coded if c), default=0)
        self.pairs, self.singles = self._hashed(coded, list(self.code))

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:  # a state for this prefix exists from another item
            if self.depth[known] == self.depth[last] + 1:
                return known
            return self._clone(last, c, known)
        new = len(self.next)
        self.next.append({})
        self.depth.append(self.depth[last] + 1)
        self.link.append(0)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            known = self.next[last][c]
            self.link[new] = known if self.depth[known] == self.depth[last] + 1 else self._clone(last, c, known)
        return new

    def _clone(self, last: int, c: int, known: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[known]))
        self.depth.append(self.depth[last] + 1)
        self.link.append(self.link[known])
        self.link[known] = copy
        while last >= 0 and self.next[last].get(c) == known:
            self.next[last][c] = copy
            last = self.link[last]
        return copy

    def _cut(self, state: int, length: int) -> tuple[int, int]:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.depth[self.link[state]] >= length:
            state = self.link[state]
        return state, length

    def _hashed(self, coded, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        own = Words(*flat(pa.array([w.decode() for w in words], pa.string())))
        single = own.hashes()
        two = {(a, b) for _, codes in coded for a, b in zip(codes, codes[1:])}
        both = np.array(sorted(two), np.int64).reshape(-1, 2)
        laid = single[both].reshape(-1)
        return np.unique(gram(laid, np.arange(0, len(laid), 2), 2)), np.unique(single)

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches [start, stop) of ``words`` in order, and the items whose windows occur."""
        state, length = 0, 0
        spans: list[list[int]] = []
        found: set[str] = set()
        for at, word in enumerate(words):
            c = self.code.get(word, -1)
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.depth[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            hit = 0
            if length >= self.window:
                found.update(self.items.get(self._cut(state, self.window)[0], ()))
                hit = length
            elif length >= self.least:
                up, most = state, length
                while up > 0:
                    if up in self.short and self.short[up][0] <= most:
                        found.update(self.short[up][1])
                        hit = max(hit, self.short[up][0])
                    up = self.link[up]
                    most = self.depth[up]
            if length >= self.window and self.short:
                up, most = state, length
                while up > 0:
                    if up in self.short and self.short[up][0] <= most:
                        found.update(self.short[up][1])
                    up = self.link[up]
                    most = self.depth[up]
            if hit:
                begin = at + 1 - hit
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, at + 1])
        return [(a, b) for a, b in spans], found


def _member(sorted_hashes: np.ndarray, sieve: np.ndarray, x: np.ndarray) -> np.ndarray:
    found = sieve[(x & np.uint64(len(sieve) - 1)).astype(np.int64)]
    at = np.flatnonzero(found)
    place = np.minimum(np.searchsorted(sorted_hashes, x[at]), len(sorted_hashes) - 1)
    found[at] = sorted_hashes[place] == x[at]
    return found


def _sieve(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << max(16, int(len(hashes) * 16).bit_length()), bool)
    out[(hashes & np.uint64(len(out) - 1)).astype(np.int64)] = True
    return out


@lru_cache(maxsize=1)
def _built(packed: bytes, window: int):
    automaton = Automaton(pickle.loads(packed), window)
    return automaton, _sieve(automaton.pairs), _sieve(automaton.singles)


def _runs(usable: np.ndarray, least: int) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], usable.view(np.int8), [0]))))
    begin, end = edge[::2], edge[1::2]
    long_enough = end - begin >= least
    return list(zip(begin[long_enough].tolist(), end[long_enough].tolist()))


def _match(words: Words, automaton: Automaton, pair_sieve, single_sieve):
    """Per text: hit stretches in word positions of the text, and items."""
    spans: list[list] = [[] for _ in words.count]
    items: list[set] = [set() for _ in words.count]
    if not len(words) or not automaton.least:
        return spans, items
    hashes = words.hashes()
    if automaton.least > 1:
        at, pair = words.grams(hashes, 2)
        usable = np.zeros(len(words), bool)
        usable[at] = _member(automaton.pairs, pair_sieve, pair) if len(at) else False
        runs = [(a, b + 1) for a, b in _runs(usable, automaton.least - 1)]
    else:
        usable = _member(automaton.singles, single_sieve, hashes)
        runs = []
        bounds = words.first
        for a, b in _runs(usable, 1):  # runs of single words may go on into the next text
            cuts = [a, *bounds[(bounds > a) & (bounds < b)].tolist(), b]
            runs += list(zip(cuts, cuts[1:]))
    data = words.data
    for a, b in runs:
        found, which = automaton.stream([data[words.start[i] : words.end[i]].tobytes() for i in range(a, b)])
        if found:
            text = int(np.searchsorted(words.first, a, side="right")) - 1
            shift = a - int(words.first[text])
            spans[text] += [{"start": x + shift, "stop": y + shift} for x, y in found]
            items[text] |= which
    return spans, items


def _scan(docs: DataFrame, key: list[str], text: str, block, window: int) -> DataFrame:
    """Columns ``key``, n_words, spans and items (sorted) of each document, against one block of items."""
    schema = ", ".join([f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key] + ["n_words long", f"spans {SPAN}", "items array<string>"])

    def run(batches):
        automaton, pair_sieve, single_sieve = _built(block.value, window)
        for batch in batches:
            for a, b, data, begins in slices(batch.column(len(key))):
                words = Words(data, begins)
                spans, items = _match(words, automaton, pair_sieve, single_sieve)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(len(key))], pa.array(words.count, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=[*key, "n_words", "spans", "items"],
                )

    return docs.select(*key, text).mapInArrow(run, schema)


def pieces(benchmark: DataFrame, item: str, text: str, window: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """Items as rows (item, words, n): long ones cut so that no window is lost; items without words give none."""

    def run(batches):
        for batch in batches:
            rows = []
            for one, words in zip(batch.column(0).to_pylist(), map(words_of, batch.column(1).to_pylist())):
                step = max(1, piece_words - window + 1)
                for i in range(0, max(1, len(words) - window + 1), step):
                    if words:
                        rows.append({"item": one, "words": words[i : i + step + window - 1], "n": len(words[i : i + step + window - 1])})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64())]))

    chosen = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), text)
    return chosen.mapInArrow(run, "item string, words array<string>, n long")


def contaminated_words(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document row: ``doc_id``, text_print (xxhash64), n_words, n_hit, spans of hit words, items whose windows occur.

    Missing texts have no words and no hits; repeated rows give repeated results; a benchmark without words
    hits nothing.
    """
    cut = stored(pieces(benchmark, item, item_text, window))
    total = cut.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    context = docs.sparkSession.sparkContext
    # a block holds about block_words words whatever the size of the benchmark
    keyed = docs.select(F.col(doc_id), F.xxhash64(F.col(text)).alias("_print"), F.col(text))
    if n_blocks == 1:
        found = _scan(keyed, [doc_id, "_print"], text, _block(context, cut), window)
    else:
        parts = []
        for b in range(n_blocks):
            own = cut.where(F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)) == b)
            parts.append(stored(_scan(keyed, [doc_id, "_print"], text, _block(context, own), window).where(F.size("spans") > 0)))
        hits = reduce(DataFrame.unionAll, parts).distinct().groupBy(F.col(doc_id).alias("_id"), "_print").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
        )
        counted = _scan(keyed, [doc_id, "_print"], text, context.broadcast(pickle.dumps([])), window).drop("spans", "items")
        found = counted.join(
            hits.withColumnRenamed("_print", "_own"), F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_own")), "left"
        ).select(doc_id, "_print", "n_words", F.coalesce(merged("spans"), F.array().cast(SPAN)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(doc_id, F.col("_print").alias("text_print"), "n_words", hit.alias("n_hit"), "spans", "items")


def merged(spans: str):
    """Overlapping and touching stretches made one."""
    last = lambda a: F.element_at(a, -1)

    def add(done, s):
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["stop"], s["stop"]).alias("stop"))),
        )
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= s["start"]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(F.col(spans)), F.array().cast(SPAN), add)


def _block(context, own: DataFrame):
    return context.broadcast(pickle.dumps([(r["item"], r["words"]) for r in own.select("item", "words").collect()]))


def is_contaminated():
    """Some hit word, and at least a twentieth of the words hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, in full. Rows that repeat an id are judged each by its text."""
    found = contaminated_words(docs, benchmark, doc_id=doc_id, text=text, **options)
    own_id, own_print = unused(docs.columns, "_id", "_print")
    bad = found.where(is_contaminated()).select(F.col(doc_id).alias(own_id), F.col("text_print").alias(own_print)).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text)) == F.col(own_print)), "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All rows of ``docs``, their texts without the stretches of hit words that are beyond the limits.

    A stretch goes if it has more than ``most_words`` words, or if the hit words are at least ``share`` of the text's. What
    a cut brings together is judged again, so no stretch beyond the limits is left. Other texts stay as they are;
    a column ``length`` (characters) follows the cut text where there is one.
    """
    return _cleaned(docs, benchmark, drop=False, **options)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """What :func:`uncontaminated` keeps, its texts cut as by :func:`without_spans`; one scan of ``docs`` serves both."""
    return _cleaned(docs, benchmark, drop=True, **options)


def _cleaned(
    docs: DataFrame, benchmark: DataFrame, *, drop: bool, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars",
    most_words: int = MOST_WORDS, share: float = SHARE, **options,
) -> DataFrame:
    own_id, own_print, bad, cuts = unused(docs.columns, "_id", "_print", "_bad", "_cuts")
    same = F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text)) == F.col(own_print))
    covered = F.col("n_hit") >= share * F.col("n_words")
    over = F.filter(merged("spans"), lambda s: covered | (s["stop"] - s["start"] > most_words))
    done, rows = [], docs
    while True:  # after the first round only the rows that were cut
        found = contaminated_words(rows, benchmark, doc_id=doc_id, text=text, **options).where("n_hit > 0").select(
            F.col(doc_id).alias(own_id), F.col("text_print").alias(own_print), (is_contaminated() if drop else F.lit(False)).alias(bad), over.alias(cuts)
        )
        found = stored(found.where(F.col(bad) | (F.size(cuts) > 0)).distinct())
        if found.isEmpty():
            return reduce(DataFrame.unionAll, [*done, rows])
        done.append(rows.join(found, same, "left_anti"))
        hit = rows.join(found.where(~F.col(bad)), same).select(*[F.col(f"`{c}`") for c in docs.columns], cuts)
        rows, drop = stored(_cut_spans(hit, text, length, docs.schema)), False


def _cut_spans(hit: DataFrame, text: str, length: str, schema) -> DataFrame:
    """The rows without the stretches of words that their last column lists."""
    at = schema.names.index(text)
    sized = schema.names.index(length) if length in schema.names else None

    def run(batches):
        for batch in batches:
            columns = batch.columns[:-1]
            out = [_without(one, spans) for one, spans in zip(columns[at].to_pylist(), batch.column(len(columns)).to_pylist())]
            columns[at] = pa.array(out, columns[at].type)
            if sized is not None:
                columns[sized] = pa.array([len(x) for x in out], pa.int64()).cast(columns[sized].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return hit.mapInArrow(run, schema)


def _without(text: str, spans: list[dict]) -> str:
    """The text from each stretch's first word to its last cut out; of the blanks on both sides, those before it stay."""
    words, raw = Words(*flat(pa.array([text], pa.string()))), text.encode()
    kept, begin = [], 0
    for span in spans:
        a, b = int(words.start[span["start"]]), int(words.end[span["stop"] - 1])
        kept.append(raw[begin:a])
        if not a or raw[a - 1 : a].isspace():
            while raw[b : b + 1] in (b" ", b"\t"):
                b += 1
        begin = b
    return b"".join([*kept, raw[begin:]]).decode()
