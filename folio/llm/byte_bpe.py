"""Byte-level BPE as DuckDB recursive queries inside each partition (op 2).

**Encoding.** A text is pre-tokenised by the vocabulary's pattern; each distinct pre-token is a word of
token-position rows ``(g, word, id, size)``, where the token after the one at ``g`` sits at
``g + size``. One round of the recursive query joins the rows with their right neighbours and the merge
table, takes each word's lowest rank, and contracts that pair at its leftmost places, until no
pair of the word has a rank. Contracting all leftmost, non-overlapping occurrences of the minimum in one
round gives the same ids as one at a time: every token of the vocabulary encodes to itself, so a
merge cannot open a pair of lower rank (a test checks this of the file).

**Decoding.** Rows ``(run, place, id)`` join the vocabulary and an ordered aggregation puts the bytes together.

Tasks remember pieces and runs (``pieces.Ragged``, bounded, with a comparison of bytes), as words repeat; every word that is
not remembered goes through the recursive query, vocabulary entries too. DuckDB runs on one
thread with a fixed memory limit, and words go in by the ten thousand. The merge table has a fixed
size, given by the vocabulary file, whose path is a parameter and must be readable on every executor.

Null and empty texts have no ids; a very long text is worked on by its pieces. Ties cannot occur (a rank belongs to one pair),
repeated rows give repeated results, null ids stay null, extra columns are not looked at, an empty table gives an empty one.
An id that the vocabulary lacks raises an error when decoding.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import SLICE_BYTES, hash_runs, list_parts, slices, table
from folio.llm.pieces import Pieces, Ragged

ROWS = 200_000  # token-position rows in one recursive query
REMEMBERED = 700_000  # pieces, words and runs that a worker remembers, of each: some 50 bytes and the piece itself
LONG = 100  # bytes of a pre-token

ENCODE = """
WITH RECURSIVE step(round, g, word, id, size) AS (
    SELECT 0, g, word, id, size FROM start
  UNION ALL (
    WITH pair AS (
        SELECT a.g, a.word, m.rank, b.g AS right_g, a.size + b.size AS size, a.round
        FROM step a JOIN step b ON b.g = a.g + a.size JOIN merges m ON m.pair = a.id * 65536::BIGINT + b.id
    ), low AS (
        SELECT word, min(rank) AS rank FROM pair GROUP BY word
    ), least AS (
        SELECT p.*, lag(p.right_g) OVER w IS NOT DISTINCT FROM p.g AS chained, row_number() OVER w AS place
        FROM pair p JOIN low USING (word, rank) WINDOW w AS (PARTITION BY p.word ORDER BY p.g)
    ), chosen AS (
        SELECT g, right_g, rank, size FROM (
            SELECT *, place - max(CASE WHEN NOT chained THEN place END) OVER (PARTITION BY word ORDER BY g) AS nth FROM least
        ) WHERE nth % 2 = 0
    )
    SELECT s.round + 1, s.g, s.word, coalesce(c.rank, s.id), coalesce(c.size, s.size)
    FROM step s SEMI JOIN low ON low.word = s.word
    LEFT JOIN chosen c ON c.g = s.g ANTI JOIN chosen d ON d.right_g = s.g
  )
)
SELECT word, id FROM step JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) USING (word, round) ORDER BY g
"""

DECODE = "SELECT run, string_agg(piece, '' ORDER BY place) AS text FROM ids JOIN vocabulary USING (id) GROUP BY run ORDER BY run"


class Coder:
    """Encoder and decoder of one vocabulary file, for one worker process."""

    def __init__(self, path: str, pattern: str):
        self.pattern = regex.compile(pattern)
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]] * 65536 + self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.register("pairs_in", pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "rank": pa.array([r for _, r in pairs], pa.int32())}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM pairs_in")
        # bytes as the 256 first code points, so that text functions work on them
        tokens = sorted(self.ranks.items(), key=lambda x: x[1])
        self.db.register("vocabulary_in", pa.table({"id": pa.array([r for _, r in tokens], pa.int32()), "piece": [t.decode("latin-1") for t, _ in tokens]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        top = max(self.ranks.values()) + 1
        self.opens = np.zeros(top, bool)  # tokens that start with a space: decoding is cut in front of them
        self.opens[[r for t, r in tokens if t[:1] == b" "]] = True
        self.words: Ragged = Ragged(np.int32, REMEMBERED)
        self.texts: Ragged = Ragged(np.int32, REMEMBERED)
        self.runs: Ragged = Ragged(np.uint8, REMEMBERED)

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids, ids) of pre-tokens, by the recursive query."""
        sizes, ids, i = np.zeros(len(words), np.int64), [], 0
        length = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(length)
        while i < len(words):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + ROWS, side="right")))
            data = np.frombuffer(b"".join(words[i:j]), np.uint8)
            word = np.repeat(np.arange(j - i), length[i:j])
            start = pa.table({"g": np.arange(len(data)) + word, "word": word, "id": self.single[data], "size": np.ones(len(data), np.int32)})
            self.db.register("start", start)
            done = self.db.sql(ENCODE).to_arrow_table()
            ids.append(done.column("id").to_numpy())
            sizes[i:j] = np.bincount(done.column("word").to_numpy(), minlength=j - i)
            i = j
        return sizes, np.concatenate(ids) if ids else np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        p = Pieces(data, offsets)

        def whole(places: np.ndarray):
            parts = [self.pattern.findall(p.word(k).decode()) for k in places]
            flat = [w.encode() for x in parts for w in x]
            text, stop = np.frombuffer(b"".join(flat), np.uint8), np.cumsum([len(w) for w in flat], dtype=np.int64)
            begin = stop - np.array([len(w) for w in flat], np.int64)
            values, size = self.words.gather(hash_runs(text, begin, stop), text, begin, stop, lambda new: self.contract([flat[k] for k in new]))
            ends = np.concatenate([[0], np.cumsum(size)])
            at = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            return np.diff(ends[at]), values

        ids, size = self.texts.gather(p.hashes(lower=False), p.data, p.start, p.end, whole)
        return ids, np.concatenate([[0], np.cumsum(size)])[p.at]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets of each text's bytes) of ragged ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.opens)):
            raise ValueError("an id that the vocabulary lacks")
        cut = np.append(self.opens[ids], True)
        cut[offsets] = True
        start = np.flatnonzero(cut[: len(ids)])
        end = np.append(start[1:], len(ids))[: len(start)]
        raw = np.ascontiguousarray(ids, "<i4").view(np.uint8)

        def whole(places: np.ndarray):
            size = (end - start)[places]
            run = np.repeat(np.arange(len(places)), size)
            place = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
            self.db.register("ids", pa.table({"run": run, "place": place, "id": ids[start[places][run] + place].astype(np.int32)}))
            done = self.db.sql(DECODE).to_arrow_table()
            texts = [t.encode("latin-1") for t in done.column("text").to_pylist()]
            if len(texts) < len(places):
                raise ValueError("an id that the vocabulary lacks")
            return np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8)

        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
        data, size = self.runs.gather(hash_runs(raw, 4 * start, 4 * end), raw, 4 * start, 4 * end, whole)
        return data, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, offsets)]


@lru_cache(maxsize=1)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


class Sizes(dict):
    """Numbers of ids of pre-tokens, for who needs no ids: one where the vocabulary has the pre-token (every token encodes to itself), else
    what is left when its lowest pairs are merged one at a time. Long pre-tokens, where that takes quadratic time, go to the recursive query.
    At most ``limit`` pre-tokens are remembered, short ones."""

    def __init__(self, path: str, pattern: str, limit: int = REMEMBERED):
        self.path, self.pattern, self.limit, self.cut = path, pattern, limit, regex.compile(pattern)
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}

    def __missing__(self, word: str) -> int:
        piece = word.encode()
        n = 1 if piece in self.ranks else self._merged(piece) if len(piece) <= LONG else int(coder(self.path, self.pattern).contract([piece])[0][0])
        if len(piece) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n

    def _merged(self, piece: bytes) -> int:
        none = len(self.ranks) + 1_000_000
        parts = [piece[i : i + 1] for i in range(len(piece))]
        near = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while near and (low := min(near)) < none:
            i = near.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i:
                near[i - 1] = self.ranks.get(parts[i - 1] + parts[i], none)
            if i < len(near):
                near[i] = self.ranks.get(parts[i] + parts[i + 1], none)
        return len(parts)

    def count(self, text: str) -> int:
        if len(text) < SLICE_BYTES:
            return sum(map(self.__getitem__, self.cut.findall(text)))
        return sum(self[m.group()] for m in self.cut.finditer(text))


@lru_cache(maxsize=1)
def sizes(path: str, pattern: str) -> Sizes:
    return Sizes(path, pattern)


def bpe_encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>)."""

    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                ids, at = c.encode(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def bpe_decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded binary); a null list decodes to no bytes."""

    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            at, ids = list_parts(batch.column(1))
            data, ends = c.decode(ids, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([data[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], names=[id_col, "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): both directions in one pass, digests only."""

    def run(batches):
        c = coder(path, pattern)
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                ids, at = c.encode(data, offsets)
                back, ends = c.decode(ids, at)
                digits = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()).cast(pa.string())), " ")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in digits]),
                        pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]),
                    ],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every text of ``documents`` with the public 50k ranks."""
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
