"""Operator 4: BPE encoding and decoding as a bounded-lookahead transducer.

Encoding. A text is cut into pre-tokens by the pattern of the vocabulary file.
A merge list only looks a bounded way to the right: a change behind position p
can reach a token left of p only through a chain of overlapping merges of
falling priority. ``sufficient_lookahead`` computes the longest such chain from
the merge list. ``StreamingBpe`` therefore merges a window of a pre-token,
emits the tokens that end at least that far before the window's end (they are
stable) and starts the next window there. A suffix of a BPE
encoding is the encoding of the suffix's text, so the restart is exact. Memory
per text is one window; the cache of short pre-tokens has a fixed size.

Decoding. Tokens stand for bytes; ``StreamingDecoder`` feeds them to an
incremental UTF-8 state machine that keeps at most three pending bytes.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; a null doc_id passes through; repeated rows are encoded each; further
input columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import hold_for_stage, record_batch, slices

#: Entries of each of the two generations of a worker's cache.
CACHE_ENTRIES = 300_000
#: Characters of a text that are normalised and split at a time (cut at white space).
BLOCK_CHARS = 1 << 16


def default_vocabulary() -> str:
    """Path of the public word BPE vocabulary on the worker that asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level BPE writes for each byte value."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in plain:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b] = chr(spare)
            spare += 1
    return out


def sufficient_lookahead(merges: list[tuple[str, str]], length: dict[str, int] | None = None) -> int:
    """Symbols to the right that can influence a token, from the merge list.

    reach[t]: how far left of its own right end a change under token t can
    travel through merges of lower priority. A later merge t is touched by an
    earlier one u if u is a part of t, or if an end of t is a beginning of u.
    """
    size = (lambda t: length[t]) if length else len
    reach: dict[str, int] = {}
    best: dict[str, int] = {}  # beginning of a token -> longest reach seen so far
    longest = 1
    for left, right in merges:
        token = left + right
        far = max(reach.get(left, 0), reach.get(right, 0))
        for i in range(1, len(token)):
            far = max(far, best.get(token[i:], 0))
        r = size(token) + far
        reach[token] = max(r, reach.get(token, 0))
        for i in range(1, len(token) + 1):
            if best.get(token[:i], 0) < r:
                best[token[:i]] = r
        longest = max(longest, r)
    return longest


def _members(pattern: str, characters: str) -> set[str]:
    """The characters that the public library's pattern takes."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    return {c for run, _ in split.pre_tokenize_str(characters) for c in run}


@functools.lru_cache(maxsize=1)
def newer_characters() -> tuple[dict[str, tuple[set[str], set[str]]], dict[int, str], set[str]]:
    """Where the public library's Unicode versions differ from those of Python
    and ``regex``: for each class the characters that it takes in addition and
    those that it does not take, its lower case of others, and the marks that
    its NFC orders or composes in another way. Classes and lower case can
    differ for characters alone that Python's data or ``regex`` does not know."""
    from tokenizers import normalizers

    every = "".join(chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000)
    unsure = "".join(regex.findall(r"\P{Cn}", "".join(c for c in every if unicodedata.category(c) == "Cn")))
    unsure += "".join(c for c in regex.findall(r"\p{Cn}", every) if unicodedata.category(c) != "Cn")
    classes = {}
    for name in (r"\p{L}", r"\p{N}"):
        own, theirs = set(regex.findall(name, unsure)), _members(name, unsure)
        classes[name] = (theirs - own, own - theirs)
    lower = normalizers.Lowercase()
    nfc = normalizers.NFC()
    same = lambda x: nfc.normalize_str(x) == unicodedata.normalize("NFC", x)
    marks = {c for c in every if unicodedata.combining(c)
             and not all(same(c + m) and same(m + c) for m in "\u0334\u0327\u0301\u0345")}
    marks |= {unicodedata.normalize("NFD", c)[-1] for c in every
              if unicodedata.decomposition(c)[:1] not in ("", "<") and not same(unicodedata.normalize("NFD", c))}
    return classes, {ord(c): low for c in unsure if (low := lower.normalize_str(c)) != c.lower()}, marks


def ranges(characters: Iterable[str]) -> str:
    """The characters as ranges of a pattern's class: thousands of single
    characters beyond U+FFFF would be compared one by one at each place."""
    found: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if found and found[-1][1] == c - 1:
            found[-1][1] = c
        else:
            found.append([c, c])
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in found)


def one_of(characters: set[str]) -> re.Pattern[str]:
    """Pattern of one of the characters. Those up to U+FFFF are a bit map to
    ``re``, so that a place with any other of that plane costs a single look."""
    if not characters:
        return re.compile("(?!)")
    low = ranges(c for c in characters if c < "\U00010000")
    return re.compile(f"(?=[{low}\U00010000-\U0010ffff])[{ranges(characters)}]")


def as_library(pattern: str, classes: dict[str, tuple[set[str], set[str]]]) -> str:
    """The pattern with its classes as the public library has them."""
    for name, (more, less) in classes.items():
        one = f"[{name}--[{ranges(less)}]]" if less else name
        pattern = pattern.replace(name, f"[{one}{ranges(more)}]")
    return pattern


class StreamingBpe:
    """Transducer over the symbol ids of one pre-token.

    ``merged`` maps a pair of ids, as ``left << 32 | right``, to
    ``rank << 32 | id of the merged token``; ``sizes`` has the number of
    symbols of each id.
    """

    NEVER = 1 << 62

    def __init__(self, merged: dict[int, int], sizes: list[int], lookahead: int):
        self.merged, self.sizes, self.lookahead = merged, sizes, lookahead

    def merge(self, symbols: list[int]) -> list[int]:
        """The BPE tokens of ``symbols``: the first pair of lowest rank merges first."""
        if len(symbols) > 64:
            return self._merge_long(symbols)
        get, never, parts = self.merged.get, self.NEVER, list(symbols)
        found = [get(a << 32 | b, never) for a, b in zip(parts, parts[1:])]
        found.append(never)
        while (best := min(found)) != never:
            i = found.index(best)
            parts[i] = token = best & 0xFFFFFFFF
            del parts[i + 1], found[i]
            if i + 1 < len(parts):
                found[i] = get(token << 32 | parts[i + 1], never)
            if i:
                found[i - 1] = get(parts[i - 1] << 32 | token, never)
        return parts

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap and a linked list, for long windows."""
        n, get, parts = len(symbols), self.merged.get, list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m >> 32, i, m) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (m := get(a << 32 | b))]
        heapq.heapify(heap)
        while heap:
            _, i, m = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or get(parts[i] << 32 | parts[j]) != m:
                continue
            parts[i], parts[j] = m & 0xFFFFFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (m := get(parts[k] << 32 | parts[after[k]])):
                    heapq.heappush(heap, (m >> 32, k, m))
        return [p for p in parts if p >= 0]

    def tokens(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of a stream of symbols, each emitted as soon as it is stable."""
        window, limit = [], 4 * self.lookahead
        for s in symbols:
            window.append(s)
            if len(window) >= limit:
                end, at = len(window) - self.lookahead, 0
                for token in self.merge(window):
                    if at + self.sizes[token] > end:
                        break
                    yield token
                    at += self.sizes[token]
                window = window[at:]
        yield from self.merge(window)


class StreamingDecoder:
    """Byte-to-text state machine: tokens in, text out as soon as it is whole."""

    def __init__(self) -> None:
        self._utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, data: bytes) -> str:
        return self._utf8.decode(data)

    def close(self) -> str:
        return self._utf8.decode(b"", final=True)


class WordBpeTokenizer:
    """Encoder and decoder for a vocabulary file of the word BPE kind (lower
    case, white space dropped, end-of-word mark). Behaves as the public
    library does with such a file: its special strings in a text become their
    ids, and decoding joins the token strings by one space."""

    END = "</w>"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.same = [0] * (max(self.strings) + 1)  # one number object for each id, not one for each place it is cached at
        for i in self.strings:
            self.same[i] = i
        splits = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(p["pattern"]["Regex"] for p in splits if p["type"] == "Split")
        classes, self.lower, marks = newer_characters()
        self.pattern, self.newer_pattern = regex.compile(pattern), regex.compile(as_library(pattern, classes), regex.V1)
        newer = set(map(chr, self.lower)).union(*self.lower.values(), *(x for pair in classes.values() for x in pair))
        self.newer, self.marks, self.unlike = one_of(newer), one_of(marks), one_of(newer | marks)
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        alphabet, ids = byte_alphabet(), self.ids
        self.inner, self.final = [ids[c] for c in alphabet], [ids[c + self.END] for c in alphabet]
        sizes = [0] * (max(self.strings) + 1)
        for i in (*self.inner, *self.final):
            sizes[i] = 1
        for left, right in merges:
            sizes[ids[left + right]] = sizes[ids[left]] + sizes[ids[right]]
        merged = {ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for rank, (a, b) in reversed([*enumerate(merges)])}
        length = {s: sizes[i] for s, i in ids.items()}
        self.bpe = StreamingBpe(merged, sizes, sufficient_lookahead(merges, length))
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    # ------------------------------------------------------------ encode
    def normalise(self, text: str) -> str:
        """NFC, then lower case of each character by itself."""
        if text.isascii():
            return text.lower()
        if not self.unlike.search(text):
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final-sigma rule
        if self.marks.search(text):
            from tokenizers import normalizers

            text = normalizers.NFC().normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()
        return text.translate(self.lower) if self.newer.search(text) else text

    def blocks(self, text: str) -> Iterator[str | int]:
        """Runs of text of bounded length, and the ids of special strings.
        Runs end before white space, which is in no pre-token and blocks
        composition; a longer run without white space stays whole."""
        at = 0
        for m in self.special_pattern.finditer(text) if "<|" in text else ():
            yield from self._runs(text[at : m.start()])
            yield self.special[m[0]]
            at = m.end()
        yield from self._runs(text[at:] if at else text)

    @staticmethod
    def _runs(text: str) -> Iterator[str]:
        at, n = 0, len(text)
        while n - at > BLOCK_CHARS:
            end = at + BLOCK_CHARS
            while end < n and text[end] not in " \t\r\n":
                end += 1
            yield text[at:end]
            at = end
        if at < n:
            yield text[at:]

    def symbols(self, word: str) -> Iterator[int]:
        """The byte symbols of a pre-token; the last one carries the end mark."""
        inner, last = self.inner, -1
        for ch in word:
            for b in ch.encode("utf-8"):
                if last >= 0:
                    yield inner[last]
                last = b
        if last >= 0:
            yield self.final[last]

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        if len(word) > 64:
            return list(self.bpe.tokens(self.symbols(word)))
        data = word.encode("utf-8")
        return self.bpe.merge([*map(self.inner.__getitem__, data[:-1]), self.final[data[-1]]])

    def pre_tokens(self, chunk: str) -> list[str]:
        """Pre-tokens of a normalised text."""
        unlike = not chunk.isascii() and self.newer.search(chunk)
        return (self.newer_pattern if unlike else self.pattern).findall(chunk)

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        """Ids of a normalised run without white space. Short runs are kept in
        two generations of a cache of bounded size."""
        got = self._old.get(chunk)
        if got is None:
            words = self.pre_tokens(chunk)
            if words == [chunk]:
                got = tuple(map(self.same.__getitem__, self.word_ids(chunk)))
            else:
                got = tuple(i for word in words for i in self._young.get(word) or self.chunk_ids(word))
        if len(chunk) <= 64:
            if len(self._young) >= CACHE_ENTRIES:
                self._old, self._young = self._young, {}
            self._young[chunk] = got
        return got

    def encode(self, text: str) -> Iterator[tuple[int, ...]]:
        """The ids of the text, a tuple for each run between white space."""
        for run in self.blocks(text):
            if isinstance(run, int):
                yield (run,)
                continue
            for chunk in self.normalise(run).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
                got = self._young.get(chunk)
                yield self.chunk_ids(chunk) if got is None else got

    # ------------------------------------------------------------ decode
    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text pieces of the ids. A file without a decoder joins the token
        strings by spaces; the strings go through the byte state machine."""
        machine, first, strings = StreamingDecoder(), True, self.strings
        for i in ids:
            yield machine.feed((("" if first else " ") + strings[i]).encode("utf-8"))
            first = False
        yield machine.close()


@functools.lru_cache(maxsize=2)
def _loaded(path: str | None) -> WordBpeTokenizer:
    return WordBpeTokenizer(path or default_vocabulary())


def let_go() -> None:
    """Forget the tokenizers with their caches."""
    _loaded.cache_clear()
    WordBpeTokenizer.joined_ids.clear()


def tokenizer(path: str | None = None) -> WordBpeTokenizer:
    """One tokenizer per worker process and file, shared by a stage's tasks."""
    hold_for_stage(let_go)
    return _loaded(path)


def _digest(tok: WordBpeTokenizer, text: str) -> tuple[int, str, str]:
    """Number of ids, digest of the ids, digest of the decoded text."""
    n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
    decoder, block = StreamingDecoder(), []
    joined = tok.joined_ids

    def flush() -> None:
        lead = " " if n > len(block) else ""
        ids_hash.update((lead + " ".join(map(joined.__getitem__, block))).encode())
        text_hash.update(decoder.feed((lead + " ".join(map(tok.strings.__getitem__, block))).encode()).encode())
        block.clear()

    for ids in tok.encode(text):
        block += ids
        n += len(ids)
        if len(block) >= 8192:
            flush()
    if block:
        flush()
    text_hash.update(decoder.close().encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


class _Decimal(dict):
    """Decimal strings of ids."""

    def __missing__(self, i: int) -> str:
        self[i] = s = str(i)
        return s


WordBpeTokenizer.joined_ids = _Decimal()


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and the token ids (array of int) of each whole text."""

    def run(batches):
        tok = tokenizer(vocabulary)
        for b in slices(batches):
            ids = [[i for w in tok.encode(t or "") for i in w] for t in b.column("text").to_pylist()]
            yield record_batch({"doc_id": b.column("doc_id"), "ids": (ids, pa.list_(pa.int32()))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and the decoded text of each row of ``encode_documents``."""

    def run(batches):
        tok = tokenizer(vocabulary)
        for b in slices(batches):
            texts = ["".join(tok.decode(ids or ())) for ids in b.column("ids").to_pylist()]
            yield record_batch({"doc_id": b.column("doc_id"), "text": (texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, of the ids
    and of the text decoded from them. One pass; no shuffle."""

    def run(batches):
        tok = tokenizer(vocabulary)
        for b in slices(batches):
            rows = [_digest(tok, t or "") for t in b.column("text").to_pylist()]
            n, ids, text = zip(*rows) if rows else ((), (), ())
            yield record_batch({"doc_id": b.column("doc_id"), "n_tokens": (n, pa.int64()),
                                "ids_sha256": (ids, pa.string()), "decoded_sha256": (text, pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
