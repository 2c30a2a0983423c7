"""BPE encoding and decoding that encodes shared chunks once.

Texts are cut where a rolling hash of the last ``WINDOW`` bytes has its top bits zero, so a passage
is cut alike wherever it stands. A chunk that several texts share is encoded once, and so is a text
that is there several times, as one chunk; all others are encoded where they are.

1. Every chunk of every text is hashed, and every text. Chunks of two different texts or more, and
   texts that come again outside the slice that a task holds, are marked in a bitmap of fixed size.
2. Texts without a mark are encoded in place: they never move (copies in one slice are encoded once).
   Of a marked text only its key goes on, and its bytes once for each slice. Texts with marked chunks
   are handed over.
3. One copy of each marked text and chunk is encoded. A text's result is joined to its key, a chunk's
   tokens to its places.
4. Joins are repaired. Tokens at both ends of a chunk may differ from those of the whole text, so the
   stretch around each cut is encoded again, a word wider each time until the tokens beside it agree
   with those at hand; if they never do, the chunk is encoded again in full with the stretch.

Tokens, decoded text and digests of a text are made in one function and one process; only what the
caller asks for leaves it. Encoding goes through a table of words: the tokenizer drops white space and
lets nothing reach over it, so a word's tokens do not depend on its neighbours. Only the six ASCII
blanks are taken for white space here; all of them are for the tokenizer too (checked when it is
loaded).
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bitmap_of, hand_over, in_bitmap, mix, texts

WINDOW = 32
#: A chunk is 2**CHUNK_BITS bytes long on average.
CHUNK_BITS = 9
#: Bytes of words and tokens that a process remembers (twice as many at most), the longest word of
#: them, and how many words are encoded in one call.
MEMORY, MEMORABLE, TOGETHER = 20 << 20, 64, 500
#: Bytes that a remembered word takes beside its letters and tokens.
ENTRY_BYTES = 160
BORDER, BORDER_BYTE = "~", b"~"

_U = np.uint64
_GEAR = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


# -- chunks -----------------------------------------------------------------------------------


def _cut_marks(raw: np.ndarray) -> np.ndarray:
    """True behind each byte where the rolling hash asks for a cut."""
    out = np.zeros(len(raw), bool)
    for a in range(0, len(raw), 1 << 20):
        start = max(0, a - WINDOW + 1)
        h = _GEAR[raw[start : a + (1 << 20)]]
        width = 1
        while width < WINDOW:
            h[width:] = h[width:] + (h[:-width] << _U(width))
            width *= 2
        out[a : a + (1 << 20)] = (h >> _U(64 - CHUNK_BITS) == 0)[a - start :]
    return out


def chunks(docs: list[bytes]) -> list[list[bytes]]:
    """Each text in content-defined chunks; no chunk ends inside a character or holds nothing."""
    joined = np.frombuffer(b"".join(docs), np.uint8)
    marks = _cut_marks(joined)
    marks[:-1] &= (joined[1:] & 0xC0) != 0x80
    cuts = np.flatnonzero(marks) + 1
    out, at = [], 0
    for doc in docs:
        own = cuts[np.searchsorted(cuts, at + WINDOW) : np.searchsorted(cuts, at + len(doc))] - at
        edges = [0, *own.tolist(), len(doc)]
        out.append([doc[a:b] for a, b in zip(edges, edges[1:])] if doc else [])
        at += len(doc)
    return out


def chunk_key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _slots(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys), ">u8").astype(_U)


# -- encoding ---------------------------------------------------------------------------------


class Encoder:
    """Tokens of byte strings, by way of the words in them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        plain = self._library("ab cd")
        for blank in " \t\n\x0b\f\r":
            if self._library(f"ab{blank}cd") != plain or self._library(blank):
                raise ValueError("the tokenizer does not drop white space; texts cannot be taken by words")
        border = self._library(BORDER)
        # a word of one token, which no word without that character has
        self.border = border[0] if len(border) == 1 else None
        self.pieces = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.decimal = [str(i).encode() for i in range(len(self.pieces))]
        # words in use (tokens as 32-bit numbers), and those in use before the last time the memory was full
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _words(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of many words, none with ``BORDER`` in it, in few calls: it stands between them."""
        if self.border is None:
            return [self._library(w.decode("utf-8", "replace")) for w in words]
        out: list[list[int]] = []
        for a in range(0, len(words), TOGETHER):
            ids = self._library(f" {BORDER} ".join(w.decode("utf-8", "replace") for w in words[a : a + TOGETHER]))
            start = 0
            for _ in range(min(TOGETHER, len(words) - a) - 1):
                end = ids.index(self.border, start)
                out.append(ids[start:end])
                start = end + 1
            out.append(ids[start:])
        return out

    def _remember(self, words: list[bytes], tokens: list[bytes]) -> None:
        self.known.update(zip(words, tokens))
        self.held += sum(map(len, words)) + sum(map(len, tokens)) + ENTRY_BYTES * len(words)

    def learn(self, parts: list[bytes]) -> None:
        """Remember the words of several strings."""
        if self.held > MEMORY:
            self.known, self.older, self.held = {}, self.known, 0
        words = set().union(*(part.split() for part in parts)).difference(self.known)
        words = [w for w in words if len(w) <= MEMORABLE and BORDER_BYTE not in w]
        again = [w for w in words if w in self.older]
        self._remember(again, [self.older[w] for w in again])
        new = [w for w in words if w not in self.known]
        self._remember(new, [_packed(ids) for ids in self._words(new)])

    def tokens(self, part: bytes) -> bytes:
        """Tokens as 32-bit numbers, one behind the other."""
        words = part.split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join(map(self._word, words))

    def encode(self, part: bytes) -> list[int]:
        return _numbers(self.tokens(part))

    def _word(self, word: bytes) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = _packed(self._library(word.decode("utf-8", "replace")))
            if len(word) <= MEMORABLE:
                self._remember([word], [ids])
        return ids

    def decode(self, ids: list[int]) -> str:
        """As the library decodes, special tokens included: without a decoder it joins the tokens."""
        if self.tokenizer.decoder is None:
            return " ".join(map(self.pieces.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _numbers(tokens: bytes) -> list[int]:
    return np.frombuffer(tokens, "<i4").tolist()


@functools.cache
def shared_encoder(path: str) -> Encoder:
    """One for a Python process, whatever tasks and stages it works for: words are learned once."""
    return Encoder(path)


def _ends(chunk: bytes, ids: bytes, encoder: Encoder) -> tuple[bytes, bytes, bytes] | None:
    """Head, tokens between, and tail of an encoded chunk.

    Head and tail reach to the first and last blank, or further until what they encode to agrees with
    the chunk's own tokens there. None if they never do, or if there is no blank.
    """
    blanks = [m.start() for m in _BLANK.finditer(chunk)] if len(chunk) < 64 else None
    reach = 1
    while True:
        a = _nth_blank(chunk, reach, blanks)
        b = _nth_blank(chunk, -reach, blanks)
        if a is None or b is None or a > b:
            return None
        head, tail = chunk[:a], chunk[b + 1 :]
        front, back = encoder.tokens(head), encoder.tokens(tail)
        cut = len(ids) - len(back)
        if len(front) <= cut and ids[: len(front)] == front and ids[cut:] == back:
            return head, ids[len(front) : cut], tail
        reach *= 2


def _nth_blank(chunk: bytes, n: int, blanks: list[int] | None) -> int | None:
    if blanks is not None:
        return blanks[n - 1 if n > 0 else n] if len(blanks) >= abs(n) else None
    found = None
    if n > 0:
        at = -1
        for _ in range(n):
            m = _BLANK.search(chunk, at + 1)
            if m is None:
                return None
            found = at = m.start()
        return found
    end = len(chunk)
    for _ in range(-n):
        found = max(chunk.rfind(c, 0, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        if found < 0:
            return None
        end = found
    return found


def _assembled(parts: list[bytes], encoded: list[bytes | None], encoder: Encoder) -> bytes:
    """Tokens of the whole text, given its chunks and their tokens (None: not encoded yet)."""
    out: list[bytes] = []
    torn: list[bytes] = []  # what lies around the last cut and is not settled
    for i, (chunk, ids) in enumerate(zip(parts, encoded)):
        if ids is None:
            ids = encoder.tokens(chunk)
        ends = _ends(chunk, ids, encoder) if len(parts) > 1 else (b"", ids, b"")
        if ends is None:
            torn.append(chunk)
            continue
        head, inner, tail = ends
        torn.append(head)
        out += [encoder.tokens(b"".join(torn)), inner]
        torn = [tail]
    return b"".join([*out, encoder.tokens(b"".join(torn))])


def assemble(parts: list[bytes], encoded: list[list[int] | None], encoder: Encoder) -> list[int]:
    return _numbers(_assembled(parts, [ids if ids is None else _packed(ids) for ids in encoded], encoder))


def _joined(parts: list[bytes], encoded: list[bytes | None]) -> tuple[list[bytes], list[bytes | None]]:
    """Chunks that are not encoded yet as one with their neighbours."""
    out: list[list[bytes]] = []
    tokens: list[bytes | None] = []
    for part, ids in zip(parts, encoded):
        if ids is None and tokens and tokens[-1] is None:
            out[-1].append(part)
        else:
            out.append([part])
            tokens.append(ids)
    return [b"".join(o) for o in out], tokens


# -- passes -----------------------------------------------------------------------------------

#: What a text gives: number of tokens, and as asked for, tokens, decoded text, and their digests.
RESULTS = {
    "n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string",
}
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


class Results:
    """Columns of results, text by text."""

    def __init__(self, encoder: Encoder, wanted: Sequence[str]):
        self.encoder, self.wanted = encoder, wanted
        self.rows: list[tuple | None] = []

    def of(self, tokens: bytes) -> tuple:
        ids = _numbers(tokens)
        need = set(self.wanted)
        decoded = self.encoder.decode(ids) if need & {"decoded", "decoded_sha256"} else None
        made = {"n_tokens": len(ids), "ids": tokens, "decoded": decoded}
        if "ids_sha256" in need:
            made["ids_sha256"] = hashlib.sha256(b" ".join(map(self.encoder.decimal.__getitem__, ids))).hexdigest()
        if "decoded_sha256" in need:
            made["decoded_sha256"] = hashlib.sha256(decoded.encode()).hexdigest()
        return tuple(made[name] for name in self.wanted)

    def columns(self) -> dict[str, pa.Array]:
        out = {}
        for k, name in enumerate(self.wanted):
            values = [row and row[k] for row in self.rows]
            if name == "ids":
                ends = np.cumsum([0, *(len(v or b"") // 4 for v in values)])
                flat = pa.array(np.frombuffer(b"".join(v or b"" for v in values), "<i4"))
                # a null is marked at its start
                starts = pa.array(ends, pa.int32(), mask=np.array([*(v is None for v in values), False]))
                out[name] = pa.ListArray.from_arrays(starts, flat)
            else:
                out[name] = pa.array(values, _KINDS[RESULTS[name]])
        return out


def _schema(wanted: Sequence[str], *others: str) -> str:
    return ", ".join([*(f"{name} {RESULTS[name]}" for name in wanted), *others])


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _text_key(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16, person=b"text").digest()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, slot, of): the chunks of every text with a mark of the text; the texts with a mark of the slice."""
    task = TaskContext.get()
    slice_no = (task.partitionId() if task else 0) << 32
    for _, raw in texts(batches):
        slice_no += 1
        different = {text for text in raw if text}
        keys = [_text_key(text) for text in different]
        of = [slice_no] * len(keys)
        for text, parts in zip(different, chunks(list(different))):
            mark = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)
            own = {chunk_key(c) for c in parts}
            keys += own
            of += [mark] * len(own)
        slots = _slots(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        yield _batch({"key": pa.array(keys, pa.binary()), "slot": pa.array(slots), "of": pa.array(of, pa.int64())})


def _encode_in_place(path: str, marked, wanted: Sequence[str]):
    """Results of texts without a mark; of marked texts the key, and the text once for the slice; of texts
    with marked chunks the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bitmap = shared_encoder(path), marked.value
        for batch, raw in texts(batches):
            different = list(dict.fromkeys(raw))
            cut = chunks(different)
            whole = [_text_key(text) for text in different]
            keys = [chunk_key(c) for doc in cut for c in doc]
            hits = in_bitmap(bitmap, _slots(keys)) if keys else np.zeros(0, bool)
            again = in_bitmap(bitmap, _slots(whole))
            at, alone = 0, set()
            for i, (text, doc) in enumerate(zip(different, cut)):
                if not text or not (again[i] or hits[at : at + len(doc)].any()):
                    alone.add(text)
                at += len(doc)
            encoder.learn(list(alone))
            results = Results(encoder, wanted)
            made = {text: results.of(encoder.tokens(text)) for text in alone}
            copies = {text: key for text, key, is_ in zip(different, whole, again.tolist()) if is_ and text}
            results.rows = [made.get(text) for text in raw]
            given: set[bytes] = set()
            body = []
            for text in raw:
                body.append(None if text in alone or text in given else text)
                if text in copies:
                    given.add(text)
            yield _batch({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), **results.columns(),
                "key": pa.array([copies.get(text) for text in raw], pa.binary()), "text": pa.array(body, pa.binary()),
            })

    return run


def _marked_chunks(marked, with_text: bool):
    """Rows of the marked chunks: their bytes, or where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in texts(batches):
            cut = chunks(raw)
            flat = [(i, p, c) for i, doc in enumerate(cut) for p, c in enumerate(doc)]
            keys = [chunk_key(c) for _, _, c in flat]
            hits = np.flatnonzero(in_bitmap(marked.value, _slots(keys))).tolist() if keys else []
            if with_text:
                first = {keys[k]: flat[k][2] for k in hits}
                yield _batch({"key": pa.array(list(first), pa.binary()), "chunk": pa.array(list(first.values()), pa.binary())})
            else:
                yield _batch({
                    "row": batch.column("row").take(pa.array([flat[k][0] for k in hits], pa.int64())),
                    "pos": pa.array([flat[k][1] for k in hits], pa.int32()), "key": pa.array([keys[k] for k in hits], pa.binary()),
                })

    return run


def _encode_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path)
        for batch, raw in texts(batches, "chunk"):
            encoder.learn(raw)
            yield _batch({"key": batch.column("key"), "ids": pa.array([encoder.tokens(c) for c in raw], pa.binary())})

    return run


def _encode_texts(path: str, wanted: Sequence[str]):
    """Results of texts that are there several times, by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path)
        for batch, raw in texts(batches):
            encoder.learn(raw)
            results = Results(encoder, wanted)
            results.rows = [results.of(encoder.tokens(text)) for text in raw]
            yield _batch({"key": batch.column("key"), **results.columns()})

    return run


def _put_together(path: str, wanted: Sequence[str]):
    """Results of texts that come with their marked chunks' places and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path)
        for batch, raw in texts(batches):
            results = Results(encoder, wanted)
            ready = []
            places = batch.column("chunks")
            for i, parts in enumerate(chunks(raw)):
                encoded: list[bytes | None] = [None] * len(parts)
                for place in places[i].as_py() or []:
                    encoded[place["pos"]] = place["ids"]
                ready.append(_joined(parts, encoded))
            encoder.learn([p for parts, encoded in ready for p, ids in zip(parts, encoded) if ids is None])
            results.rows = [results.of(_assembled(parts, encoded, encoder)) for parts, encoded in ready]
            yield _batch({"doc_id": batch.column("doc_id"), **results.columns()})

    return run


def encode(docs: DataFrame, path: str, wanted: Sequence[str] = tuple(RESULTS)) -> DataFrame:
    """``doc_id`` and of ``n_tokens, ids, decoded, ids_sha256, decoded_sha256`` those ``wanted``, for every row.

    ``ids`` are the tokens and ``decoded`` the text they decode to; the digests are of the decimal ids
    joined by single spaces and of the decoded text. A null text counts as empty (no tokens; digests of
    nothing). Repeated rows and null ids each give a row; other columns are not looked at.
    """
    wanted = [name for name in RESULTS if name in wanted]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    sc = docs.sparkSession.sparkContext
    counted = docs.select("text").mapInArrow(_count, "key binary, slot bigint, of bigint")
    shared = counted.groupBy("key", "slot").agg(F.min("of").alias("low"), F.max("of").alias("high")).filter("low <> high")
    marked = sc.broadcast(bitmap_of(shared, "slot"))
    first = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _encode_in_place(path, marked, wanted), f"row bigint, doc_id bigint, {_schema(wanted, 'key binary', 'text binary')}"
    )
    first = hand_over(first, "bpe-first")  # from here on a row's number is fixed
    done = first.filter(F.col("key").isNull() & F.col("text").isNull()).select("doc_id", *wanted)

    again = first.filter(F.col("key").isNotNull())
    bodies = again.filter(F.col("text").isNotNull()).groupBy("key").agg(F.first("text").alias("text"))
    once = hand_over(bodies.mapInArrow(_encode_texts(path, wanted), f"key binary, {_schema(wanted)}"), "bpe-texts")
    copies = again.select("key", "doc_id").join(once, "key").select("doc_id", *wanted)

    waiting = first.filter(F.col("key").isNull() & F.col("text").isNotNull()).select("row", "doc_id", "text")
    pieces = waiting.select("text").mapInArrow(_marked_chunks(marked, True), "key binary, chunk binary")
    pieces = pieces.groupBy("key").agg(F.first("chunk").alias("chunk"))
    tokens = hand_over(pieces.mapInArrow(_encode_chunks(path), "key binary, ids binary"), "bpe-chunks")
    places = waiting.select("row", "text").mapInArrow(_marked_chunks(marked, False), "row bigint, pos int, key binary")
    found = hand_over(places, "bpe-places").join(tokens, "key")
    # a text's own chunks: as many as its length allows
    per_row = found.groupBy("row").agg(F.collect_list(F.struct("pos", "ids")).alias("chunks"))
    late = waiting.join(per_row, "row").mapInArrow(_put_together(path, wanted), f"doc_id bigint, {_schema(wanted)}")
    return done.union(copies).union(late)
