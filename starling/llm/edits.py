"""Operator 10: edit-aware token counts.

A document is kept as a segment tree over its pre-token runs: a leaf is a run
between white space with the white space behind it, its pre-tokens encoded and
counted; leaves lie in blocks, and every tree node has the characters and
tokens below it. White space is in no pre-token, special string or composed
character, so a run is encoded by itself and an edit can change only the runs
it touches and the run before it, to which it may be joined.

An edit (position, characters deleted, text inserted) is located by walking
down the character sums. Only the touched region and its boundary run are
joined, split and encoded again; their block's sums change, and with them those
of the nodes above, O(log n) of them.

Defined cases: a null or empty text is a document without leaves; edits apply
in their order to the text as it then is; a position before the start or
behind the end, or a deletion past the end, is clipped to the text; null
fields of an edit are 0 and the empty string; a null list has no edits;
repeated rows are counted each; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.bpe import CACHE_ENTRIES, WordBpeTokenizer, tokenizer
from starling.llm.common import record_batch, slices

#: Leaves of a block when a tree is built.
BLOCK_LEAVES = 32
RUN = re.compile(r"[^ \t\r\n]*[ \t\r\n]+|[^ \t\r\n]+")


class Counter:
    """Token counts of leaves, in two generations of a bounded cache."""

    def __init__(self, tok: WordBpeTokenizer):
        self.tok, self.young, self.old = tok, {}, {}

    def __call__(self, leaf: str) -> int:
        n = self.young.get(leaf)
        if n is None:
            n = self.old.get(leaf)
            if n is None:
                n = sum(map(len, self.tok.encode(leaf)))
            if len(leaf) <= 64:
                if len(self.young) >= CACHE_ENTRIES:
                    self.old, self.young = self.young, {}
                self.young[leaf] = n
        return n


class TokenTree:
    """Segment tree over blocks of leaves; node i has the sums of 2i and 2i+1."""

    def __init__(self, text: str, count: Counter):
        self.count, self.encoded = count, 0
        leaves = RUN.findall(text)
        self.blocks = [leaves[i : i + BLOCK_LEAVES] for i in range(0, len(leaves), BLOCK_LEAVES)] or [[]]
        self.tokens = [[*map(count, b)] for b in self.blocks]
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, b in enumerate(self.blocks):
            self.chars[self.size + i], self.sums[self.size + i] = sum(map(len, b)), sum(self.tokens[i])
        for i in range(self.size - 1, 0, -1):
            self._add_up(i)

    def _add_up(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1]

    @property
    def n_leaves(self) -> int:
        return sum(map(len, self.blocks))

    def text(self) -> str:
        return "".join(map("".join, self.blocks))

    def locate(self, at: int) -> tuple[int, int, int]:
        """(block, leaf, offset in the leaf) of a character position; the end
        of the text is the end of its last leaf."""
        i = 1
        at = max(0, min(at, self.chars[1]))
        end = at == self.chars[1]
        at -= end
        while i < self.size:
            i *= 2
            if at >= self.chars[i]:
                at -= self.chars[i]
                i += 1
        block, leaf = self.blocks[i - self.size], 0
        while leaf < len(block) and at >= len(block[leaf]):
            at -= len(block[leaf])
            leaf += 1
        return i - self.size, leaf, at + end

    def _before(self, block: int, leaf: int) -> tuple[int, int] | None:
        """The leaf before a leaf, over empty blocks."""
        while leaf == 0:
            block -= 1
            if block < 0:
                return None
            leaf = len(self.blocks[block])
        return block, leaf - 1

    def edit(self, at: int, delete: int, insert: str) -> None:
        """Replace ``delete`` characters at ``at`` by ``insert``."""
        at = max(0, min(at, self.n_chars))
        delete = max(0, min(delete, self.n_chars - at))
        if not self.n_chars:
            self._splice(0, 0, 0, 0, insert)
            return
        b0, l0, o0 = self.locate(at)
        b1, l1, o1 = self.locate(at + delete) if delete else (b0, l0, o0)
        head, tail = self.blocks[b0][l0][:o0], self.blocks[b1][l1][o1:]
        if not head and (before := self._before(b0, l0)):  # what is new may belong to the run before
            b0, l0 = before
            head = self.blocks[b0][l0]
        if not tail or tail.strip(" \t\r\n") == "":  # and white space or the next run to what is left
            after = self._after(b1, l1)
            if after:
                tail += self.blocks[after[0]][after[1]]
                b1, l1 = after
        self._splice(b0, l0, b1, l1 + 1, head + insert + tail)

    def _after(self, block: int, leaf: int) -> tuple[int, int] | None:
        leaf += 1
        while leaf >= len(self.blocks[block]):
            block, leaf = block + 1, 0
            if block >= len(self.blocks):
                return None
        return block, leaf

    def _splice(self, b0: int, l0: int, b1: int, l1: int, region: str) -> None:
        """Encode ``region`` in place of the leaves from (b0, l0) to before (b1, l1)."""
        leaves = RUN.findall(region)
        counts = [*map(self.count, leaves)]
        self.encoded += len(leaves)
        if b0 == b1:
            self.blocks[b0][l0:l1], self.tokens[b0][l0:l1] = leaves, counts
        else:
            self.blocks[b0][l0:], self.tokens[b0][l0:] = leaves, counts
            for b in range(b0 + 1, b1):
                self.blocks[b], self.tokens[b] = [], []
            self.blocks[b1][:l1], self.tokens[b1][:l1] = [], []
        for b in range(b0, b1 + 1):
            self._update(b)

    def _update(self, block: int) -> None:
        i = self.size + block
        self.chars[i], self.sums[i] = sum(map(len, self.blocks[block])), sum(self.tokens[block])
        while i > 1:
            i //= 2
            self._add_up(i)


def count_edited(docs: DataFrame, edits: str = "edits", vocabulary: str | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, n_tokens and n_leaves of the text,
    n_chars_edited and n_tokens_edited after the edits of column ``edits``
    (array of struct at, removed, inserted), n_reencoded (leaves encoded for
    them) and edited_sha256. One pass, no shuffle."""
    listed = F.transform(edits, lambda e: F.struct(
        F.coalesce(e["at"].cast("long"), F.lit(0)).alias("at"),
        F.coalesce(e["removed"].cast("long"), F.lit(0)).alias("removed"),
        F.coalesce(e["inserted"], F.lit("")).alias("inserted")))

    def run(batches):
        count = Counter(tokenizer(vocabulary))
        for b in slices(batches):
            rows = []
            for text, changes in zip(b.column("text").to_pylist(), b.column("edits").to_pylist()):
                tree = TokenTree(text or "", count)
                row = [tree.n_chars, tree.n_tokens, tree.n_leaves]
                for e in changes or ():
                    tree.edit(e["at"], e["removed"], e["inserted"])
                digest = hashlib.sha256(tree.text().encode("utf-8")).hexdigest()
                rows.append((*row, tree.n_chars, tree.n_tokens, tree.encoded, digest))
            cols = [*zip(*rows)] if rows else [()] * 7
            names = ("n_chars", "n_tokens", "n_leaves", "n_chars_edited", "n_tokens_edited", "n_reencoded")
            yield record_batch({"doc_id": b.column("doc_id"), **{n: (c, pa.int64()) for n, c in zip(names, cols)},
                                "edited_sha256": (cols[6], pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", listed.alias("edits")).mapInArrow(
        run, "doc_id long, n_chars long, n_tokens long, n_leaves long, n_chars_edited long, n_tokens_edited long, "
             "n_reencoded long, edited_sha256 string")
