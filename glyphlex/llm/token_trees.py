"""Token counts that follow edits.

A byte-level BPE never merges over the borders of the pre-tokens that its pattern
finds.  About LEAF_CHARS of consecutive pre-tokens are a leaf of the document's
segment tree; every node holds the characters and tokens below it.  The trees are
a column of a table, next to the texts.

Leaves are cut at a single space between two other characters, and between a mark
(no apostrophe) and a letter, in any script.  There the pattern always starts a new
pre-token, whatever stands further away, so such a border stays one for as long as
the character before it and the two after it stay.  An edit finds its leaf by the
character sums, goes out to the nearest borders that it leaves whole, and encodes
only what lies between them; the leaves there get new sums, and the nodes above them.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, prepare

#: Characters after which a leaf is cut at the next border; leaves that have grown
#: to GROWN times that are cut anew (the document's tree is laid out again).
LEAF_CHARS, GROWN = 400, 8
#: Most edits of one document in one pass.
PASS_EDITS = 1000
TREE = "struct<chars: array<int>, tokens: array<int>>"
EDITS = "array<struct<at: int, removed: int, added: string>>"

_SOLID = r"[^\s\p{Z}\p{C}]"
_BORDER = regex.compile(
    rf"(?<={_SOLID}) (?={_SOLID})|(?<=(?!')[\p{{P}}\p{{S}}])(?=[\x00-\uffff])(?=\p{{L}})")


class Encoder:
    """Tokens of a text by a rank file of a byte-level BPE and its pattern, which must
    be one that takes a space with what stands behind it, and keeps marks apart from
    letters but for contractions after an apostrophe."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves of a text (one empty leaf for none)."""
        chars, tokens, at = [], [], 0
        while at < len(text) or not chars:
            m = _BORDER.search(text, at + LEAF_CHARS)
            end = m.start() if m else len(text)
            chars.append(end - at)
            tokens.append(self.count(text[at:end]))
            at = end
        return np.array(chars, np.int64), np.array(tokens, np.int64)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def layout(leaf: np.ndarray) -> np.ndarray:
    """Nodes of a tree: node k has children 2k and 2k + 1, node 1 is the root, and
    the leaves are the second half."""
    half = 1 << max(0, int(len(leaf) - 1).bit_length())
    nodes = np.zeros(2 * half, np.int64)
    nodes[half:half + len(leaf)] = leaf
    while half > 1:
        nodes[half // 2:half] = nodes[half:2 * half].reshape(-1, 2).sum(axis=1)
        half //= 2
    return nodes


class Tree:
    """One document's tree."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens

    @staticmethod
    def build(text: str, encode: Encoder) -> Tree:
        return Tree(*map(layout, encode.leaves(text)))

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (or the last one with any), and
        where it starts."""
        half, node, start = len(self.chars) // 2, 1, 0
        at = min(at, max(0, int(self.chars[1]) - 1))
        while node < half:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - half, start

    def put(self, first: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """New values of the leaves from ``first`` on, and of the nodes above them."""
        for nodes, new in ((self.chars, chars), (self.tokens, tokens)):
            low = len(nodes) // 2 + first
            high = low + len(new)
            nodes[low:high] = new
            while low > 1:
                low, high = low // 2, (high + 1) // 2
                nodes[low:high] = nodes[2 * low:2 * high].reshape(-1, 2).sum(axis=1)

    def edit(self, text: str, at: int, removed: int, added: str, encode: Encoder) -> tuple[str, int]:
        """Returns the new text and the number of characters that were encoded again."""
        at = min(max(at, 0), len(text))
        stop = min(at + max(removed, 0), len(text))
        new = text[:at] + added + text[stop:]
        half = len(self.chars) // 2
        first, start = self.find(max(0, at - 2))  # the two characters at its border stay
        last, place = self.find(stop)
        end = place + int(self.chars[half + last])  # behind ``stop``: the letter before it stays
        if end >= len(text):
            last, end = half - 1, len(text)
        part = new[start:end + len(new) - len(text)]
        chars, tokens = encode.leaves(part)
        slots = last - first + 1
        if len(chars) > GROWN * slots:
            own = [np.concatenate([x[half:half + first], y, x[half + last + 1:]])
                   for x, y in ((self.chars, chars), (self.tokens, tokens))]
            has = own[0] > 0
            self.chars, self.tokens = (layout(x[has]) for x in own)
            return new, len(part)
        if len(chars) > slots:  # the leaves that are there take more
            cut = np.arange(slots) * len(chars) // slots
            chars, tokens = np.add.reduceat(chars, cut), np.add.reduceat(tokens, cut)
        fill = np.zeros(slots - len(chars), np.int64)
        self.put(first, np.concatenate([chars, fill]), np.concatenate([tokens, fill]))
        return new, len(part)


def _trees(trees: list[Tree]) -> pa.Array:
    parts = []
    for name in ("chars", "tokens"):
        own = [getattr(t, name) for t in trees]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        flat = np.concatenate(own) if own else np.zeros(0, np.int64)
        parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))))
    return pa.StructArray.from_arrays(parts, ["chars", "tokens"])


def build_trees(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """The struct ``_row`` (all columns), its ``tree`` and ``n_tokens`` for every row.

    Null and empty texts have an empty tree and no tokens; an empty table gives an
    empty result; columns of any name are carried inside ``_row``.  ``ranks`` is a
    file that every worker can read."""
    prepare(docs.sparkSession)

    @F.arrow_udf(TREE)
    def build(texts: pa.Array) -> pa.Array:
        encode = encoder(ranks, pattern)
        return _trees([Tree.build(t or "", encode) for t in texts.to_pylist()])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       build(F.col(f"`{text}`")).alias("tree")).withColumn("n_tokens", n_tokens(F.col("tree")))


def n_tokens(tree: Column) -> Column:
    """The root's sum."""
    return F.get(tree["tokens"], F.lit(1)).cast("long")


def apply_edits(text: Column, tree: Column, edits: Column, ranks: str, pattern: str) -> Column:
    """Struct (text, tree, encoded): the edited text, its tree, and the characters
    that were encoded again.  ``edits`` (EDITS) are applied in order; places count
    characters of the text as it is then, and beyond its end mean its end.  Null
    text, null edits and null parts of an edit count as empty or zero."""

    @F.arrow_udf(f"struct<text: string, tree: {TREE}, encoded: long>")
    def edit(texts: pa.Array, trees: pa.Array, todo: pa.Array) -> pa.Array:
        encode = encoder(ranks, pattern)
        out, own, encoded = [], [], []
        for k, (t, e) in enumerate(zip(texts.to_pylist(), todo.to_pylist())):
            t = t or ""
            tree = Tree(*(x[k].values.to_numpy().astype(np.int64) for x in (trees.field(0), trees.field(1))))
            n = 0
            for x in e or ():
                t, used = tree.edit(t, x["at"] or 0, x["removed"] or 0, x["added"] or "", encode)
                n += used
            out.append(t)
            own.append(tree)
            encoded.append(n)
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.string()), _trees(own), pa.array(encoded, pa.int64())],
            ["text", "tree", "encoded"])
    return edit(text, tree, edits)


def apply_edit_table(state: DataFrame, edits: DataFrame, ranks: str, pattern: str, text: str = "text",
                     doc_id: str = "doc_id") -> DataFrame:
    """Edits from a table (doc_id, seq, at, removed, added) on a table (doc_id, text,
    tree): the same columns, edited.  A document's edits are taken in the order of
    ``seq``, at most PASS_EDITS of them a pass, so no task holds all edits of a
    busy document.  Identifiers of ``state`` are unique; edits of others are left out."""
    numbered = edits.select(
        F.col("doc_id").alias("edit_id"),
        F.row_number().over(W.partitionBy("doc_id").orderBy("seq")).alias("n"),
        F.struct(F.col("at").cast("int").alias("at"), F.col("removed").cast("int").alias("removed"),
                 F.col("added").alias("added")).alias("e"))
    numbered = materialize(numbered.withColumn("pass", F.floor((F.col("n") - 1) / PASS_EDITS)), "edits")
    last = numbered.agg(F.max("pass")).first()[0]
    for p in range(0, -1 if last is None else last + 1):
        todo = (numbered.where(F.col("pass") == p).groupBy("edit_id")
                .agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("todo"))
                .select("edit_id", F.transform("todo", lambda x: x["e"]).alias("todo")))
        state = (state.join(todo, F.col(doc_id) == F.col("edit_id"), "left")
                 .withColumn("done", apply_edits(F.col(text), F.col("tree"), F.col("todo"), ranks, pattern))
                 .withColumn(text, F.col("done.text")).withColumn("tree", F.col("done.tree"))
                 .drop("edit_id", "todo", "done"))
        state = materialize(state, "edited")
    return state
