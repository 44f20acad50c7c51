"""Removal of benchmark passages with a generalised suffix automaton.

All test items, as normalised words, go into one suffix automaton. Training texts are streamed through
it word by word; the automaton's state says at every word how long a stretch ending there occurs in some
item. A stretch of ``window`` words is an occurrence of an item's window, an item with fewer words is one
window as a whole. Words inside any occurrence are hit.

Texts stay where they are; the automaton travels. One holds at most ``block_words`` item words. Larger
benchmarks are dealt into blocks, each of which passes over the texts once and reports only those it hits.

Defined results: a null or wordless text has no words and no hits; an item without words has no window;
equal items each count, by item_id; a null item_id is named by the empty string; an empty benchmark hits
nothing. Repeated rows are judged alike and columns besides those named are ignored or handed on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

WINDOW = 10
#: Words in one automaton; bounds what an executor keeps, about 100 MB.
BLOCK_WORDS = 100_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: What a pass hands on, from the rows, their word counts, hit spans (flat) and found items.
Finish = Callable[[pa.Array, list[int], list[list[int]], list[list[str]]], pa.RecordBatch]


class SuffixAutomaton:
    """All substrings of the items; ``next``, ``link`` and ``length`` by state, state 0 is the empty string."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = sorted({name for name, words in items if words})
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _state(self, length: int, link: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, target: int, word: bytes) -> int:
        """The state for the longest string of ``state`` followed by ``word``, cloned off ``target`` if needed."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, self.next[last][word], word)
        return new

    def _mark(self, items: list[tuple[str, list[bytes]]]) -> None:
        """Which windows, and which short items, end in a state."""
        number = {name: k for k, name in enumerate(self.names)}
        # The state on the suffix path that holds the last ``window`` words of a state's strings.
        self.tail = [0] * len(self.next)
        by_length = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for state in by_length:
            if self.length[state] >= self.window:
                self.tail[state] = self.tail[self.link[state]] or state
        self.owners: dict[int, set[int]] = {}
        whole: dict[int, set[tuple[int, int]]] = {}
        for name, words in items:
            state = 0
            for k, word in enumerate(words):
                state = self.next[state][word]
                if k + 1 >= self.window:
                    self.owners.setdefault(self.tail[state], set()).add(number[name])
            if 0 < len(words) < self.window:
                whole.setdefault(state, set()).add((len(words), number[name]))
        self.short: dict[int, frozenset[tuple[int, int]]] = {}
        for state in by_length if whole else ():
            ends = self.short.get(self.link[state], frozenset()) | whole.get(state, frozenset())
            if ends:
                self.short[state] = ends

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Stretches [start, end) of hit words in order, merged where they touch, and numbers of found items."""
        edges, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        first = edges[0].get
        state = matched = 0
        found: set[int] = set()
        spans: list[list[int]] = []
        for i, word in enumerate(words):
            if state == 0:
                state = first(word, 0)
                if state == 0:
                    continue
                matched = 1
            else:
                target = edges[state].get(word)
                if target is None:
                    while state > 0 and word not in edges[state]:
                        state = link[state]
                    matched = length[state]
                    target = edges[state].get(word)
                    if target is None:
                        matched = 0
                        continue
                state = target
                matched += 1
            size = 0
            if matched >= window:
                found |= self.owners[self.tail[state]]
                size = window
            if short and state in short:
                for n, item in short[state]:
                    if n <= matched:
                        found.add(item)
                        size = max(size, n)
            if size:
                start = i + 1 - size
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return spans, found


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    name = F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit(""))
    return texts.with_id(benchmark, item=name, text=F.col(f"`{text}`")).where("text IS NOT NULL")


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
             item_id: str = "item_id", text: str = "text") -> Iterator[SuffixAutomaton]:
    """One automaton for each block of items; a block is collected only when its turn comes."""
    items = _items(benchmark, item_id, text)
    # No more words than every second byte.
    words = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(words / (3 * block_words)))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item", "text").collect()
        yield SuffixAutomaton(sorted((r["item"], texts.normal_words(r["text"].encode())) for r in rows), window)


def overlaps(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW,
             block_words: int = BLOCK_WORDS, text: str = "text") -> DataFrame:
    """row (a struct of columns ``keep``), n_words, spans (pairs of word places, flat) and items of every row."""
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("_text"))
    result = T.StructType([
        source.schema["row"], T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType())),
    ])
    return _judged(source, benchmark, window, block_words, _listed, result)


def _judged(source: DataFrame, benchmark: DataFrame, window: int, block_words: int, finish: Finish, result: T.StructType) -> DataFrame:
    """``source`` (row, _text) through the automata, and what ``finish`` makes of rows and hits, in one pass."""
    spark = source.sparkSession
    built = list(_first_two(automata(benchmark, window, block_words)))
    if len(built) == 1:
        return source.mapInArrow(_scanner(spark.sparkContext.broadcast(built[0]), finish), result)
    # Several blocks: each reports the texts it hits under their digest; the reports meet by digest.
    hit = T.StructType([T.StructField("digest", T.StringType()), T.StructField("spans", T.ArrayType(T.LongType())),
                        T.StructField("items", T.ArrayType(T.StringType()))])
    digest = F.sha2(F.col("_text"), 256)
    distinct = source.select("_text").where("_text IS NOT NULL").distinct().select(digest.alias("digest"), "_text")
    reports = None
    for automaton in automata(benchmark, window, block_words):
        report = distinct.mapInArrow(_scanner(spark.sparkContext.broadcast(automaton), _only_hits), hit)
        reports = report if reports is None else reports.unionByName(report)
    united = reports.groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    empty = SuffixAutomaton([], window)
    counted = source.withColumn("digest", digest).join(united, "digest", "left").select(
        "row", "_text", F.col("spans").alias("_spans"), F.col("items").alias("_items"))
    return counted.mapInArrow(_scanner(spark.sparkContext.broadcast(empty), finish), result)


def _first_two(found: Iterator[SuffixAutomaton]) -> Iterator[SuffixAutomaton]:
    for k, automaton in enumerate(found):
        yield automaton
        if k:
            return


def _merged(flat: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _scanner(automaton, finish: Finish):
    """A pass over rows; columns _spans and _items, if there, hold what other blocks found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton.value
        for part in texts.slices(batches, "_text"):
            found = [texts.normal_words(t) for t in texts.as_bytes(part.column("_text"))]
            n_words = [len(w) for w in found]
            judged = [own.matches(w) for w in found]
            spans = [[x for span in s for x in span] for s, _ in judged]
            items = [sorted(own.names[k] for k in names) for _, names in judged]
            if "_spans" in part.schema.names:
                spans = [_merged(x or []) for x in part.column("_spans").to_pylist()]
                items = [sorted(x or []) for x in part.column("_items").to_pylist()]
            yield finish(part.column(0), n_words, spans, items)

    return texts.tidy(run)


def _listed(row: pa.Array, n_words: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    """Every row with what was found."""
    columns = [row, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["row", "n_words", "spans", "items"])


def _only_hits(digest: pa.Array, n_words: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    """Rows in which something was found."""
    columns = [digest, pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["digest", "spans", "items"]).filter(pa.array([bool(x) for x in spans], pa.bool_()))


def n_hit() -> Column:
    """Words inside the stretches of column ``spans``."""
    starts = F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2))
    total = F.aggregate(starts, F.lit(0).cast("long"), lambda n, k: n + F.get("spans", k + 1) - F.get("spans", k))
    return F.when(F.size("spans") > 0, total).otherwise(F.lit(0).cast("long"))


def digest_columns(found: DataFrame) -> DataFrame:
    """The kept columns with counts and the digest of found items, for the rows of ``overlaps``."""
    return found.select(
        "row.*", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def cut_words(text: str, spans: list[int]) -> str:
    """``text`` without the words in ``spans`` and what stands between them."""
    places = [m.span() for m in WORD.finditer(text)]
    pieces, at = [], 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        pieces.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return " ".join(p for p in (x.strip() for x in [*pieces, text[at:]]) if p)


def remove_passages(docs: DataFrame, benchmark: DataFrame, max_span: int = 0, max_coverage: float = 0.5,
                    window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without hit stretches longer than ``max_span`` words, text and n_chars adjusted.

    A document of which more than ``max_coverage`` of the words are hit goes as a whole.
    """
    names = docs.columns
    numbered = docs.toDF(*[f"c{k}" for k in range(len(names))])
    source = numbered.select(F.struct(*numbered.columns).alias("row"), F.col(f"c{names.index('text')}").alias("_text"))
    sized = names.index("n_chars") if "n_chars" in names else None
    place = names.index("text")

    def cut(row: pa.Array, n_words: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
        """Rows with shortened texts, without those that are benchmark text for the most part."""
        hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
        left = [k for k, n in enumerate(n_words) if n == 0 or hit[k] <= n * max_coverage]
        rows = row.take(pa.array(left, pa.int64()))
        columns = rows.flatten()
        changed: dict[int, str] = {}
        for at, k in enumerate(left):
            pairs = zip(spans[k][::2], spans[k][1::2], strict=True)
            long = [x for start, end in pairs if end - start > max_span for x in (start, end)]
            if long:
                changed[at] = cut_words(columns[place][at].as_py(), long)
        if changed:
            columns[place] = _replaced(columns[place], changed)
            if sized is not None:
                columns[sized] = _replaced(columns[sized], {at: len(t) for at, t in changed.items()})
        return pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=list(row.type))], ["row"])

    result = T.StructType([source.schema["row"]])
    return _judged(source, benchmark, window, block_words, cut, result).select("row.*").toDF(*names)


def _replaced(column: pa.Array, values: dict[int, object]) -> pa.Array:
    """``column`` with new values at some places."""
    mask = np.zeros(len(column), bool)
    mask[list(values)] = True
    return pc.replace_with_mask(column, pa.array(mask), pa.array([values[k] for k in sorted(values)], column.type))
