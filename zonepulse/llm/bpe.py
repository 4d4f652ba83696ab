"""BPE encoding and decoding as a streaming transducer.

The tokenizer file fixes vocabulary, merge list and special strings. Text is cut at white
space into words and each word into runs of letters, single digits and other signs, so a
run is the unit the merges work on. A run is read from left to right into a window. The
merge list bounds how far a symbol can act to the left: a merge is only ever prevented by
a merge of higher rank that overlaps it, that one by one of still higher rank, and so on.
``lookahead`` is the farthest such chain reaches, computed once from the list. Tokens that
end more than ``lookahead`` symbols before the window's end are therefore final: they are
emitted and their symbols leave the window. Memory is the window, however long the run.

Decoding feeds ids one by one to a state machine that holds at most the open bytes of one
character (byte-level decoders) or nothing (files without a decoder, whose texts are the
token strings joined by spaces).

Defined results:

* null text: empty text, no tokens; white space only: no tokens;
* the special strings of the file give their own ids wherever they stand in a text;
* repeated rows and ids: each row is encoded; empty table: empty result;
* other columns are passed on or ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from zonepulse.llm.common import read_table, small_batches

#: Fixed value: the run pattern of the tokenizer file, for text without white space.
RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
#: White space of the file's patterns; str.split() takes these and the four below.
SPACE = re.compile("[%s]+" % "".join(map(chr, (
    *range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD_END = "</w>"
#: Words of up to so many characters are remembered with their tokens.
REMEMBERED = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [names[b] for b in range(256)]


class Decoder:
    """Incremental ids-to-text machine; ``feed`` returns the text that is now certain."""

    def __init__(self, tokens: dict[int, str], byte_level: bool) -> None:
        self.tokens, self.first = tokens, True
        self.bytes = {s: b for b, s in enumerate(byte_symbols())} if byte_level else None
        self.open = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        if self.bytes is None:
            out = "".join(" " + self.tokens[i] for i in ids)
            if self.first and out:
                self.first, out = False, out[1:]
            return out
        raw = bytearray()
        for i in ids:
            token = self.tokens[i]
            known = [self.bytes.get(c) for c in token]
            raw += token.encode() if None in known else bytes(known)
        return self.open.decode(bytes(raw))

    def reset(self) -> Decoder:
        self.first = True
        self.open.reset()
        return self

    def finish(self) -> str:
        return "" if self.bytes is None else self.open.decode(b"", True)


class _Recent(dict):
    """Entries made by ``make`` on first use. Two generations of ``limit`` entries each are
    kept: what was not used during a whole generation is forgotten."""

    def __init__(self, make, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> tuple[int, str, str]:
        entry = self.old.get(key)
        if entry is None:
            entry = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = entry
        return entry


class _Ranks(dict):
    """Rank of each pair; pairs that do not merge are noted as ``NEVER``, at most ``extra`` of them."""

    NEVER = 1 << 60

    def __init__(self, merges: list[tuple[str, str]], extra: int = 300_000) -> None:
        super().__init__((m, r) for r, m in reversed(list(enumerate(merges))))
        self.merges, self.most = merges, len(self) + extra

    def __missing__(self, pair: tuple[str, str]) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update((m, r) for r, m in reversed(list(enumerate(self.merges))))
        self[pair] = self.NEVER
        return self.NEVER


class Bpe:
    """Encoder and decoder of one tokenizer file (BPE over bytes with word ends)."""

    def __init__(self, path: str, cache_words: int = 300_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError(f"{path}: not a BPE vocabulary with {WORD_END}")
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = _Ranks(self.merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.symbols = byte_symbols()
        self.machine = self.decoder()
        self.words, self.runs = _Recent(self._word, cache_words), _Recent(self._run, cache_words)

    def decoder(self) -> Decoder:
        return Decoder(self.strings, self.byte_level)

    @cached_property
    def lookahead(self) -> int:
        """Symbols to the right that can still change a token (sound for any text).

        ``reach`` of a merge is how far beyond its own end its presence can depend on
        symbols: over merges of higher rank that overlap it and end later, the largest
        overhang plus their reach. ``beyond`` holds, for every part of the merges so far,
        the largest number of symbols after that part plus reach.
        """
        starts: dict[tuple, int] = {}
        parts: dict[tuple, int] = {}
        most = longest = 0
        for left, right in self.merges:
            whole = self._symbols_of(left) + self._symbols_of(right)
            n = len(whole)
            reach = parts.get(whole, 0)
            for i in range(1, n):
                reach = max(reach, starts.get(whole[i:], 0))
            for i in range(n):
                for j in range(i + 1, n):
                    part = whole[i:j]
                    if parts.get(part, -1) < n - j + reach:
                        parts[part] = n - j + reach
                    if i == 0 and starts.get(part, -1) < n - j + reach:
                        starts[part] = n - j + reach
            most, longest = max(most, reach), max(longest, n)
        return most + longest

    @staticmethod
    def _symbols_of(token: str) -> tuple[str, ...]:
        if token.endswith(WORD_END):
            body = token[: -len(WORD_END)]
            return (*body[:-1], body[-1] + WORD_END)
        return tuple(token)

    def merge(self, parts: list[str]) -> list[str]:
        """All merges of one window, always the highest-ranked leftmost pair next."""
        rank, never = self.rank, _Ranks.NEVER
        if len(parts) <= 64:
            ranks = list(map(rank.__getitem__, zip(parts, parts[1:])))
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                i = ranks.index(best)
                del ranks[i]
                parts[i] += parts.pop(i + 1)
                if i < len(ranks):
                    ranks[i] = rank[parts[i], parts[i + 1]]
                if i:
                    ranks[i - 1] = rank[parts[i - 1], parts[i]]
            return parts
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:])) if (r := rank.get(p, never)) < never]
        heapq.heapify(heap)
        gone = [False] * len(parts)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= len(parts) or (parts[i], parts[j]) != pair:
                continue
            parts[i], gone[j], after[i] = parts[i] + parts[j], True, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                if (r := rank.get(p := (parts[i], parts[after[i]]), never)) < never:
                    heapq.heappush(heap, (r, i, p))
            if before[i] >= 0 and (r := rank.get(p := (parts[before[i]], parts[i]), never)) < never:
                heapq.heappush(heap, (r, before[i], p))
        return [p for p, g in zip(parts, gone) if not g]

    def run_ids(self, run: str, block: int = 1 << 14) -> Iterator[list[int]]:
        """Ids of one run, in lists, as soon as they are stable.

        Blocks of symbols enter the window. A block that ends the run makes all tokens
        stable, another one those that end ``lookahead`` symbols before the window's end.
        """
        vocab, symbols = self.vocab, self.symbols
        raw = run.encode("utf-8")
        window: list[str] = []
        for start in range(0, len(raw), block):
            window += [symbols[b] for b in raw[start: start + block]]
            if start + block >= len(raw):
                window[-1] += WORD_END
                yield [vocab[p] for p in self.merge(window)]
                return
            stable, out = len(window) - self.lookahead, []
            taken = 0
            for token in self.merge(list(window)):
                if taken + len(token) > stable:     # one character a symbol inside a run
                    break
                taken += len(token)
                out.append(vocab[token])
            window = window[taken:]
            if out:
                yield out

    def _run(self, run: str) -> tuple[int, str, str]:
        """Number of tokens, ids and decoded text of a short run."""
        ids = [i for block in self.run_ids(run) for i in block]
        return len(ids), " ".join(map(str, ids)), self.machine.reset().feed(ids)

    @staticmethod
    def _normal(word: str) -> str:
        return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()

    def _word(self, word: str) -> tuple[int, str, str]:
        """The same of a short text without white space, or of a special string."""
        if word in self.special:
            return 1, str(self.special[word]), word
        text = self._normal(word)
        if text.isascii() and text.isalpha():
            return self.runs[text]
        parts = [self.runs[run] for run in RUNS.findall(text)]
        if len(parts) == 1:
            return parts[0]
        return (sum([p[0] for p in parts]), " ".join([p[1] for p in parts]),
                ("" if self.byte_level else " ").join([p[2] for p in parts]))

    def stream(self, word: str) -> Iterator[tuple[int, str, str]]:
        """The same of any word in parts: one per list of stable tokens, none kept."""
        if word in self.special:
            yield self._word(word)
            return
        for run in RUNS.finditer(self._normal(word)):
            for ids in self.run_ids(run.group()):
                yield len(ids), " ".join(map(str, ids)), self.machine.reset().feed(ids)

    def parts(self, words: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """Entries of words in lists: remembered ones of short words, streamed ones of long words."""
        if max(map(len, words), default=0) <= REMEMBERED:
            yield list(map(self.words.__getitem__, words))
            return
        for word in words:
            if len(word) <= REMEMBERED:
                yield [self.words[word]]
            else:
                for part in self.stream(word):
                    yield [part]

    def split_words(self, text: str) -> list[str]:
        """Words of a text; each special string is a word of its own."""
        if self.special_at is not None and self.special_at.search(text):
            out, end = [], 0
            for m in self.special_at.finditer(text):
                out += self.split_words(text[end: m.start()])
                out.append(m.group())
                end = m.end()
            return out + self.split_words(text[end:])
        if SEPARATORS.search(text):
            return [w for w in SPACE.split(text) if w]
        return text.split()

    def pieces(self, text: str, size: int = 1 << 18) -> Iterator[list[str]]:
        """The words of a text in lists of about ``size`` characters, cut at white space."""
        start = 0
        while start < len(text):
            cut = start + size
            if cut < len(text):
                gap = SPACE.search(text, cut)
                cut = gap.end() if gap else len(text)
            yield self.split_words(text[start:cut])
            start = cut

    def encode(self, text: str) -> list[int]:
        return [int(i) for words in self.pieces(text) for part in self.parts(words) for e in part for i in e[1].split()]

    def decode(self, ids) -> str:
        machine = self.decoder()
        return machine.feed(ids) + machine.finish()

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens and SHA-256 of the ids (decimal, one space) and the decoded text.

        Words decode on their own here: without a decoder in the file the text of a
        sequence is the texts of its words, joined by a space.
        """
        if self.byte_level:
            ids = self.encode(text)
            return len(ids), _sha(" ".join(map(str, ids))), _sha(self.decode(ids))
        n, ids_sha, text_sha, sep = 0, hashlib.sha256(), hashlib.sha256(), ""
        for words in self.pieces(text):
            for entries in self.parts(words):
                if not entries:
                    continue
                n += sum([e[0] for e in entries])
                ids_sha.update((sep + " ".join([e[1] for e in entries])).encode())
                text_sha.update((sep + " ".join([e[2] for e in entries])).encode("utf-8"))
                sep = " "
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


@lru_cache(maxsize=2)
def load(path: str | None = None) -> Bpe:
    """The tokenizer of a file, once per Python process.

    A worker opens the file itself: without a path the installed vocabulary, which every
    node has with its Python, else a file that all nodes have at that path.
    """
    return Bpe(path or default_path())


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _map_text(docs: DataFrame, keep: list[str], fields: list[StructField], row, path: str | None) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``fields``, computed by ``row(bpe, text)`` per document."""
    source = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            rows = [row(bpe, t.as_py() if t.is_valid else "") for t in batch.column(len(keep))]
            columns = list(zip(*rows)) or [[] for _ in fields]
            kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(list(c), kinds[f.dataType.simpleString()]) for c, f in zip(columns, fields)],
                [*keep, *(f.name for f in fields)])

    return small_batches(source).mapInArrow(run, StructType([*(docs.schema[k] for k in keep), *fields]))


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every document."""
    return _map_text(docs, ["doc_id"], [StructField("ids", ArrayType(IntegerType()))],
                     lambda bpe, text: (bpe.encode(text),), path)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ``text`` of rows (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(x.as_py() if x.is_valid else []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, StructType([encoded.schema["doc_id"], StructField("text", StringType())]))


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
              StructField("decoded_sha256", StringType())]
    return _map_text(docs, ["doc_id"], fields, lambda bpe, text: bpe.digests(text), path)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word vocabulary of 49k entries."""
    return token_digests(read_table(spark, sf_dir, "documents"))
