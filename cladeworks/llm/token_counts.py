"""Edit-aware token counts: a segment tree of pre-token counts per document.

A text is cut into pre-tokens, each is encoded by byte-level BPE, and the counts
are the leaves of a segment tree whose inner nodes hold the sums of characters
and tokens.  An edit re-encodes from the last pre-token that cannot see it up to
the first old boundary that the new cutting meets again; what lies before and
after keeps its leaves, and only the sums on the path to the root change.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The public byte-level BPE cutting rule.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A pre-token can depend on so many characters after its end.
LOOKAHEAD = 2
#: Pre-tokens in one leaf block; remembered counts a worker.
BLOCK, CACHE = 32, 1 << 18


class Counter:
    """Token counts of pre-tokens for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.cut = regex.compile(pattern)
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            n = len(self.encode(piece))
            if len(piece) <= 64:
                self.known[piece] = n
        return n

    def pieces(self, text: str, start: int = 0) -> Iterator[tuple[int, int]]:
        """(characters, tokens) of the pre-tokens from ``start`` on."""
        for m in self.cut.finditer(text, start):
            yield m.end() - m.start(), self.count(m.group())


class _Node:
    """Inner node of the tree: sums of both children; or a leaf block of pre-tokens."""

    __slots__ = ("left", "right", "items", "chars", "tokens", "count")

    def __init__(self, left=None, right=None, items=None):
        self.left, self.right, self.items = left, right, items
        if items is not None:
            self.chars, self.tokens, self.count = sum(x[0] for x in items), sum(x[1] for x in items), len(items)
        else:
            self.chars, self.tokens, self.count = left.chars + right.chars, left.tokens + right.tokens, left.count + right.count


def build(items: list[tuple[int, int]]) -> _Node:
    level = [_Node(items=items[i : i + BLOCK]) for i in range(0, len(items), BLOCK)] or [_Node(items=[])]
    while len(level) > 1:
        level = [_Node(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _join(a: _Node, b: _Node) -> _Node:
    if not a.count or not b.count:
        return b if not a.count else a
    if a.items is not None and b.items is not None and a.count + b.count <= BLOCK:
        return _Node(items=a.items + b.items)
    if a.items is None and a.count > 3 * b.count:  # keeps both sides of a node comparable
        return _Node(a.left, _join(a.right, b))
    if b.items is None and b.count > 3 * a.count:
        return _Node(_join(a, b.left), b.right)
    return _Node(a, b)


def _split(node: _Node, chars: int) -> tuple[_Node, _Node]:
    """Cuts at a pre-token boundary."""
    if node.items is not None:
        k = at = 0
        while k < node.count and at < chars:
            at += node.items[k][0]
            k += 1
        return _Node(items=node.items[:k]), _Node(items=node.items[k:])
    if chars <= node.left.chars:
        a, b = _split(node.left, chars)
        return a, _join(b, node.right)
    a, b = _split(node.right, chars - node.left.chars)
    return _join(node.left, a), b


def _boundary(node: _Node, at: int) -> int:
    """The last boundary that is not after ``at`` (a pre-token's start, or the end of the text)."""
    base = 0
    while node.items is None:
        if at < node.left.chars:
            node = node.left
        else:
            base, at, node = base + node.left.chars, at - node.left.chars, node.right
    here = 0
    for n, _ in node.items:
        if here + n > at:
            break
        here += n
    return base + here


class Document:
    """A text with its tree.  ``replace`` edits it; ``encoded`` counts the pre-tokens that were encoded for edits."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.encoded = text, counter, 0
        self.root = build(list(counter.pieces(text)))

    @property
    def tokens(self) -> int:
        return self.root.tokens

    def replace(self, start: int, end: int, new: str) -> None:
        """Replaces code points [start, end), both clamped to the text."""
        n = len(self.text)
        start = min(max(start, 0), n)
        end = min(max(end, start), n)
        # the first pre-token whose end and lookahead reach the edit
        begin = _boundary(self.root, max(start - LOOKAHEAD - 1, 0)) if start else 0
        while begin and _boundary(self.root, begin - 1) < begin and begin > start - LOOKAHEAD:
            begin = _boundary(self.root, begin - 1)
        self.text = self.text[:start] + new + self.text[end:]
        shift, done, at, items = len(new) - (end - start), None, begin, []
        for piece in self.counter.pieces(self.text, begin):
            if at >= start + len(new) and at - shift >= end and _boundary(self.root, at - shift) == at - shift:
                done = at - shift
                break
            items.append(piece)
            at += piece[0]
        left, rest = _split(self.root, begin)
        right = _split(rest, done - begin)[1] if done is not None else _Node(items=[])
        self.encoded += len(items)
        self.root = _join(_join(left, build(items)), right)


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_COUNTERS: dict[int, tuple[Counter, object]] = {}


def _counter(sent) -> Counter:
    if id(sent.value) not in _COUNTERS:  # the cache keeps the value, so its id stays its own
        _COUNTERS.clear()
        _COUNTERS[id(sent.value)] = (Counter(sent.value), sent.value)
    return _COUNTERS[id(sent.value)][0]


def _counted(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    counter = _counter(sent)
    names = ["n_chars", "n_tokens", "n_pieces", "edited_chars", "edited_tokens", "encoded_pieces"]
    for batch in batches:
        rows = []
        for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
            doc = Document(text or "", counter)
            before = (len(doc.text), doc.tokens, doc.root.count)
            for e in edits or ():
                if e and e["start"] is not None:
                    doc.replace(e["start"], e["start"] if e["end"] is None else e["end"], e["new"] or "")
            rows.append((*before, len(doc.text), doc.tokens, doc.encoded))
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", *names])


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the column ``edits`` from a table (doc_id, seq, start, end, new), in the order of seq."""
    own = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "new"))).alias("edits"))
    own = own.withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"), e["new"].alias("new"))))
    return docs.drop("edits").join(own, "doc_id", "left")


def count_tokens(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id and the counts before and after ``edits`` (array of start, end, new; code points, applied in order).

    A null text is empty; null or missing edits change nothing; an edit's null
    start is skipped, a null end inserts, a null new text deletes, and both
    ends are clamped to the text.  Repeated rows are counted one by one; an
    empty table gives an empty result.  The vocabulary goes to the tasks as a
    broadcast of its fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    long = "n_chars long, n_tokens long, n_pieces long, edited_chars long, edited_tokens long, encoded_pieces long"
    edits = F.col("edits") if "edits" in docs.columns else F.lit(None).cast("array<struct<start:long,end:long,new:string>>").alias("edits")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), edits)
    return rows.mapInArrow(lambda batches: _counted(batches, sent), f"doc_id {kind}, {long}")


def sample_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with three edits a document: an insertion at a third, a deletion at half, a replacement at two thirds."""
    n = F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    third, half, two = F.floor(n / 3), F.floor(n / 2), F.floor(2 * n / 3)
    edit = lambda a, size, new: F.struct(a.cast("long").alias("start"), (a + size).cast("long").alias("end"), F.lit(new).alias("new"))
    return docs.withColumn("edits", F.array(edit(third, 0, " newly added"), edit(half, 7, ""), edit(two, 12, "Other words.\n\n")))
