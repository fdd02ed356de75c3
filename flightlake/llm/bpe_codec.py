"""BPE encoding and decoding by speculation and verification.

Words repeat, so each batch encodes its distinct unseen words only. For those
a greedy longest match proposes tokens. A proposal is the BPE result exactly
when every two adjacent tokens, merged alone, stay these two tokens; the pairs
of all proposals are looked up at once in a sorted array of known verdicts
(unknown pairs are decided once by merging them). Words with a failing pair
alone undergo the exact merge loop.

The vocabulary file gives the normal form and the word pattern: Unicode NFC,
lower case character by character, words by letter class, digits one by one,
white space dropped, a word-end mark on the last symbol, and special strings
taken out of the raw text first.

Memory: the word table of a Python worker holds at most ``MAX_WORDS`` words of
at most ``MAX_CACHED`` bytes (some 290 bytes a word, 60 MB) beside 100 MB of
vocabulary and starts anew when full; a batch is one Arrow batch. No shuffle.

Defined cases: a null text counts as empty; an empty text has no tokens and
decodes to the empty text; repeated rows each get a row; an empty table gives
an empty result; other columns are not read, and result columns get underscores
where ``keep`` has their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, map_batches

MAX_WORDS = 200_000
MAX_CACHED = 256
MAX_PAIRS = 4_000_000
NEVER = 1 << 60
END = "\x00"     # stands for the word-end mark; no byte symbol is spelt so
# Fixed value: the word pattern of the vocabulary file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = "\n"   # leads a special string in a list of words; no word holds white space


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def other_normal_form() -> str:
    """Characters that Python's NFC treats unlike the tokenizer library's, whose
    tables are of another Unicode version: alone, or between a letter and a mark
    that composes with it. Marks of two classes show any difference in class."""
    from tokenizers import normalizers

    nfc = normalizers.NFC()
    around = [("", ""), ("A", "\u0301"), ("C", "\u0327")]
    marks = [c for c in map(chr, range(0x110000)) if unicodedata.combining(c) or unicodedata.decomposition(c)[:1] not in ("", "<")]
    return "".join(c for c in marks if any(unicodedata.normalize("NFC", t) != nfc.normalize_str(t) for t in (a + c + b for a, b in around)))


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.id = {self._internal(s): i for s, i in model["vocab"].items()}
        self.size = max(self.token) + 1
        self.spelling = {i: s for s, i in self.id.items()}
        self.rank = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self._internal(a), self._internal(b)] = r
        self.longest: dict[str, int] = {}
        for s in self.id:
            self.longest[s[0]] = max(self.longest.get(s[0], 1), len(s))
        self.word = regex.compile(WORDS)
        # Characters whose class differs between Unicode versions: those that
        # only one of the two tables at hand has.
        unassigned = "".join(filter(lambda c: unicodedata.category(c) == "Cn", map(chr, range(0x110000))))
        newer = "".join(regex.findall(r"\P{Cn}", unassigned)) + other_normal_form()
        self.newer = frozenset(newer)
        low = "".join(c for c in newer if c <= "\uffff")
        self.low = re.compile(f"[{re.escape(low)}]" if low else r"(?!)")
        self.high = re.compile("[\U00010000-\U0010ffff]")
        self.path, self.library = path, None
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        # A byte's symbol; translate() maps Latin-1 characters (bytes) to it.
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.words: dict[str, tuple[str, str, int]] = {}
        self.pairs = np.empty(0, np.int64)
        self.fits = np.empty(0, bool)

    def _internal(self, token: str) -> str:
        return token[: -len(self.suffix)] + END if token.endswith(self.suffix) else token

    # --- text to words

    def split(self, text: str) -> list[str]:
        """Words of the normalised text; special strings stay whole, marked."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += [SPECIAL + part] if i % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if self.low.search(text) or self.high.search(text) and not self.newer.isdisjoint(text):
                return self._newer(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final-sigma rule
        return self.word.findall(text.lower())

    def _newer(self, text: str) -> list[str]:
        """Words of a text with characters that Unicode versions class
        differently: there the tokenizer's own tables decide."""
        if self.library is None:
            from tokenizers import Regex, Tokenizer, pre_tokenizers
            t = Tokenizer.from_file(self.path)
            self.library = t.normalizer, pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)
        normal, words = self.library
        return [w for w, _ in words.pre_tokenize_str(normal.normalize_str(text))]

    # --- words to tokens

    def spell(self, word: str) -> str:
        """The byte symbols of a word, with the end mark glued to the last."""
        return word.encode().decode("latin-1").translate(self.symbols) + END

    def propose(self, s: str) -> list[int]:
        """Greedy longest match; a token never leaves the end mark alone."""
        out, at, n, ids = [], 0, len(s), self.id
        while at < n:
            end = min(n, at + self.longest[s[at]])
            while True:
                if end != n - 1 and (i := ids.get(s[at:end])) is not None:
                    break
                end -= 1
            out.append(i)
            at = end
        return out

    def symbols_of(self, s: str) -> list[str]:
        """The single symbols of a spelt word or word part; the end mark is no symbol."""
        return [*s[:-2], s[-2:]] if s[-1] == END else [*s]

    def merge(self, s: str) -> list[int]:
        """The exact merge result: lowest rank first, leftmost first."""
        parts = self.symbols_of(s)
        if len(parts) > 64:
            return self._merge_long(parts)
        rank = self.rank.get
        ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NEVER)
        return [self.id[p] for p in parts]

    def _merge_long(self, parts: list[str | None]) -> list[int]:
        """As ``merge``, in n log n: a heap of places over a linked list."""
        nxt, prv = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1)
                if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [self.id[p] for p in parts if p is not None]

    def compatible(self, codes: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair code stay apart when merged alone."""
        codes, back = np.unique(codes, return_inverse=True)
        at = np.searchsorted(self.pairs, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.pairs)
        known[inside] = self.pairs[at[inside]] == codes[inside]
        verdict = np.zeros(len(codes), bool)
        verdict[known] = self.fits[at[known]]
        fresh = np.flatnonzero(~known)
        for k in fresh:
            a, b = divmod(int(codes[k]), self.size)
            verdict[k] = self.merge(self.spelling[a] + self.spelling[b]) == [a, b]
        if len(fresh):
            if len(self.pairs) > MAX_PAIRS:
                self.pairs, self.fits = self.pairs[:0], self.fits[:0]
            pairs = np.concatenate([self.pairs, codes[fresh]])
            order = np.argsort(pairs)
            self.pairs, self.fits = pairs[order], np.concatenate([self.fits, verdict[fresh]])[order]
        return verdict[back]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of distinct words: propose, check all adjacent pairs, mend."""
        spelt = [self.spell(w) for w in words]
        proposed = [self.propose(s) for s in spelt]
        flat = np.fromiter((t for p in proposed for t in p), np.int64)
        owner = np.repeat(np.arange(len(words)), [len(p) for p in proposed])
        inner = owner[1:] == owner[:-1]
        codes = (flat[:-1] * self.size + flat[1:])[inner]
        bad = np.unique(owner[:-1][inner][~self.compatible(codes)]) if len(codes) else []
        for w in bad:
            proposed[w] = self.merge(spelt[w])
        return proposed

    # --- whole texts

    def learn(self, words: set[str]) -> dict[str, tuple[str, str, int]]:
        """Entries (ids, decoded, count) of words that the table lacks."""
        special = [w for w in words if w[0] == SPECIAL]
        plain = [w for w in words if w[0] != SPECIAL]
        entries = {w: (str(self.special[w[1:]]), w[1:], 1) for w in special}
        for w, ids in zip(plain, self.encode_words(plain)):
            entries[w] = (" ".join(map(str, ids)), " ".join([self.token[i] for i in ids]), len(ids))
        return entries

    def encode_texts(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(token count, ids joined by a space, decoded text) of each text."""
        split = [self.split(t) if t else [] for t in texts]
        fresh = {w for words in split for w in words if w not in self.words}
        entries = self.learn(fresh) if fresh else {}
        if len(self.words) + len(entries) > MAX_WORDS:
            seen = {w for words in split for w in words}
            entries |= {w: self.words[w] for w in seen if w in self.words}
            self.words = {}
            table = entries
        else:
            self.words.update((w, e) for w, e in entries.items() if len(w) <= MAX_CACHED)
            table = self.words if all(len(w) <= MAX_CACHED for w in entries) else {**self.words, **entries}
        for words in split:
            found = [table[w] for w in words]
            yield sum([e[2] for e in found]), " ".join([e[0] for e in found]), " ".join([e[1] for e in found])

    def encode(self, text: str | None) -> list[int]:
        _, ids, _ = next(self.encode_texts([text]))
        return [int(i) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _mapped(docs: DataFrame, keep: list[str], text_col: str, tokenizer: str | None, fields: str, build) -> DataFrame:
    path = tokenizer or default_tokenizer()
    (text,) = columns([text_col])
    held = [c.alias(f"k{i}") for i, c in enumerate(columns(keep))]  # the caller's names may be any
    src = docs.select(*held, text.cast("string").alias("text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema[:-1])
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Small slices keep the strings of few texts in memory at a time.
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                rows = codec(path).encode_texts(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *build(rows)], names=[*part.schema.names[:-1], *names])

    out = map_batches(src, run, ", ".join(x for x in (kept, fields) if x))
    return out.toDF(*keep, *[fresh(n, keep) for n in names])


def encode_documents(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``keep`` columns with ``ids`` (array of token ids) and ``decoded``."""
    def build(rows):
        rows = list(rows)
        return [pa.array([[int(i) for i in ids.split()] for _, ids, _ in rows], pa.list_(pa.int32())),
                pa.array([d for _, _, d in rows], pa.string())]

    return _mapped(docs, keep or ["doc_id"], text_col, tokenizer, "ids array<int>, decoded string", build)


def encode_digests(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``keep`` columns with ``n_tokens`` and digests of the ids and the decoded text."""
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def build(rows):
        rows = [(n, sha(ids), sha(decoded)) for n, ids, decoded in rows]
        return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]

    return _mapped(docs, keep or ["doc_id"], text_col, tokenizer, "n_tokens long, ids_sha256 string, decoded_sha256 string", build)
