"""Byte-level BPE by recursive DuckDB queries inside the tasks.

Spark deals out the texts; every task holds the merge table in its own in-memory DuckDB and runs SQL over the
rows of its Arrow batches. Texts become pieces, new pieces become (word, position, token) rows, and a recursive
query joins neighbours with the merge table and contracts each word's leftmost pair of least rank until no pair
is left. Decoding joins ids with the vocabulary and puts the bytes together by an ordered aggregate.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import digest, fresh, text_or_empty

# The piece pattern's classes as the tokenizer library knows them. White space is spelled out, and
# letters and numbers that DuckDB's expressions do not know as such yet are added by code point.
SPACE = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NEW_LETTERS = (
    r"\x{1C89}\x{1C8A}\x{A7CB}-\x{A7CD}\x{A7DA}-\x{A7DC}\x{105C0}-\x{105F3}\x{10D4A}-\x{10D65}\x{10D6F}-\x{10D85}"
    r"\x{10EC2}-\x{10EC4}\x{11380}-\x{11389}\x{1138B}\x{1138E}\x{11390}-\x{113B5}\x{113B7}\x{113D1}\x{113D3}"
    r"\x{11BC0}-\x{11BE0}\x{13460}-\x{143FA}\x{16100}-\x{1611D}\x{16D40}-\x{16D6C}\x{18CFF}\x{1E5D0}-\x{1E5ED}"
    r"\x{1E5F0}\x{2EBF0}-\x{2EE5D}"
)
NEW_NUMBERS = r"\x{10D40}-\x{10D49}\x{116D0}-\x{116E3}\x{11BF0}-\x{11BF9}\x{16130}-\x{16139}\x{16D70}-\x{16D79}\x{1CCF0}-\x{1CCF9}\x{1E5F1}-\x{1E5FA}"
LETTER, NUMBER = rf"\p{{L}}{NEW_LETTERS}", rf"\p{{N}}{NEW_NUMBERS}"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"

# White space and the word behind it: no piece reaches over the end of such a chunk.
CHUNK = f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
PIECE = f"{ENDINGS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"

SLICE_BYTES = 2 << 20
BATCH_BYTES = 400_000
LONG = 64
VERY_LONG = 1024
ROUNDS, LONG_ROUNDS = 64, 16
KNOWN = 500_000

# White space before a word is one piece but for its last character; a last blank goes to the word.
PIECES = f"""
SELECT chunk, CASE WHEN body = '' THEN [gap] ELSE
    list_concat(CASE WHEN length(gap) > 1 THEN [left(gap, -1)] ELSE [] END,
      CASE WHEN gap <> '' AND right(gap, 1) <> ' ' THEN [right(gap, 1)] ELSE [] END,
      regexp_extract_all(CASE WHEN right(gap, 1) = ' ' THEN ' ' || body ELSE body END, $piece)) END AS pieces
FROM (SELECT chunk, gap, substr(chunk, length(gap) + 1) AS body FROM (
  SELECT chunk, regexp_extract(chunk, '^[{SPACE}]*') AS gap FROM fresh_chunks))"""

_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BORDER = re.compile(f"(?<=[^{_BLANK}])[{_BLANK}]")

# Ranks are ids; a word's leftmost pair of least rank is the least (rank, position).
CONTRACT = """
WITH RECURSIVE t(key, step, token) AS (
  SELECT word * 4294967296 + pos, 0, token FROM tokens
  UNION ALL
  SELECT CASE WHEN t.key > b.key THEN t.key - 1 ELSE t.key END, step + 1, CASE WHEN t.key = b.key THEN b.merged ELSE token END
  FROM t JOIN (
    SELECT word, word * 4294967296 + least % 4294967296 AS key, least // 4294967296 AS merged FROM (
      SELECT a.key >> 32 AS word, min(m.merged * 4294967296 + (a.key & 4294967295)) AS least
      FROM t a JOIN t b ON b.key = a.key + 1 JOIN merges m ON m.pair = a.token * 4294967296 + b.token GROUP BY 1)) b
  ON b.word = t.key >> 32
  WHERE t.key <> b.key + 1 AND step < $rounds
)
SELECT word, key & 4294967295 AS pos, token, step FROM (SELECT key >> 32 AS word, key, token, step FROM t)
JOIN (SELECT key >> 32 AS word, max(step) AS step FROM t GROUP BY 1) USING (word, step)"""

# For long words: all places of the least rank at once, every other one in a chain of overlapping places. It
# equals one place after another if no pair with the new token ranks before it ("calm"); else only the first goes.
CONTRACT_LONG = """
WITH RECURSIVE t(word, step, pos, token) AS (
  SELECT word, 0, pos, token FROM tokens
  UNION ALL
  SELECT word, step + 1, pos - gone AS pos, CASE WHEN hit THEN merged ELSE token END FROM (
    SELECT t.word, t.step, t.pos, t.token, c.merged, c.pos IS NOT NULL AS hit,
      coalesce(sum((c.pos IS NOT NULL)::BIGINT) OVER (PARTITION BY t.word ORDER BY t.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS gone,
      coalesce(lag(c.pos IS NOT NULL) OVER (PARTITION BY t.word ORDER BY t.pos), false) AS taken
    FROM t SEMI JOIN (SELECT DISTINCT a.word FROM t a JOIN t b ON b.word = a.word AND b.pos = a.pos + 1 JOIN merges m ON m.pair = a.token * 4294967296 + b.token) going USING (word)
    LEFT JOIN (
      SELECT word, pos, merged FROM (
        SELECT word, pos, merged, calm, nth, row_number() OVER (PARTITION BY word, pos - nth ORDER BY pos) AS inside FROM (
          SELECT word, pos, merged, calm, row_number() OVER (PARTITION BY word ORDER BY pos) AS nth FROM (
            SELECT a.word, a.pos, m.merged, m.calm, min(m.merged) OVER (PARTITION BY a.word) AS least
            FROM t a JOIN t b ON b.word = a.word AND b.pos = a.pos + 1 JOIN merges m ON m.pair = a.token * 4294967296 + b.token)
          WHERE merged = least))
      WHERE CASE WHEN calm THEN inside % 2 = 1 ELSE nth = 1 END) c ON c.word = t.word AND c.pos = t.pos
    WHERE step < $rounds)
  WHERE NOT taken
)
SELECT t.word, t.pos, t.token, step FROM t JOIN (SELECT word, max(step) AS step FROM t GROUP BY word) USING (word, step)"""


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file (a line per token: base64, rank) as it goes to the tasks; its size is bounded by the tokenizer's."""
    with open(path, "rb") as file:
        return file.read()


def parse_vocabulary(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


@dataclass
class Tables:
    """A task's database and, to encode, the merge table with the byte pairs that every merged token holds."""

    con: duckdb.DuckDBPyConnection
    byte_ids: np.ndarray | None = None
    merges: pa.Table | None = None
    pairs: np.ndarray | None = None
    first_pair: np.ndarray | None = None

    def merges_for(self, data: np.ndarray) -> pa.Table:
        """Merges whose token's neighbouring bytes all stand somewhere beside each other in `data`; no other can occur."""
        seen = np.zeros(1 << 16, dtype=bool)
        seen[data[:-1].astype(np.int64) << 8 | data[1:]] = True
        return self.merges.filter(pa.array(np.logical_and.reduceat(seen[self.pairs], self.first_pair))) if len(self.pairs) else self.merges


def open_tables(lines: bytes, merging: bool) -> Tables:
    """An in-memory database of one thread with the vocabulary and, to encode, the merge table."""
    ranks = parse_vocabulary(lines)
    con = duckdb.connect(config={"threads": 1, "memory_limit": "640MB", "temp_directory": ""})
    con.register("given", pa.table({"id": pa.array(ranks.values(), pa.int64()), "token": pa.array(ranks.keys(), pa.binary())}))
    con.execute("CREATE TABLE vocabulary AS SELECT id::INTEGER AS id, token, hex(token) AS hexed FROM given ORDER BY id")
    tables = Tables(con)
    if merging:
        # Every way to put a token together from two others.
        split = [(ranks[t[:i]], ranks[t[i:]], r, t) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = (np.array([s[i] for s in split], dtype=np.int64) for i in range(3))
        con.register("given", pa.table({"l": left, "r": right, "merged": merged}))
        # "calm": no merge with the new token ranks before the merge that made it.
        calm = """SELECT l * 4294967296 + r AS pair, merged, coalesce(soonest, 9223372036854775807) > merged AS calm FROM given LEFT JOIN (
            SELECT token, min(merged) AS soonest FROM (SELECT l AS token, merged FROM given UNION ALL SELECT r, merged FROM given) GROUP BY token)
          s ON s.token = given.merged ORDER BY given.rowid"""
        number = pa.array(np.arange(len(split)))
        con.register("given", pa.table({"l": left, "r": right, "merged": merged, "rowid": number}))
        tables.merges = arrow(con, calm)
        size = np.array([len(s[3]) - 1 for s in split], dtype=np.int64)
        data = np.frombuffer(b"".join(s[3] for s in split), dtype=np.uint8).astype(np.int64)
        # Pairs of neighbouring bytes, token by token: all neighbours but those across the end of a token.
        tables.pairs = np.delete(data[:-1] << 8 | data[1:], np.cumsum(size + 1)[:-1] - 1) if len(split) else data
        tables.first_pair = np.cumsum(size) - size
        tables.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        con.execute("CREATE TABLE known(chunk VARCHAR, ids INTEGER[])")
        con.execute("CREATE TABLE coded(piece VARCHAR, ids INTEGER[])")
    con.unregister("given")
    return tables


def arrow(con: duckdb.DuckDBPyConnection, sql: str, values: dict | None = None) -> pa.Table:
    return con.sql(sql, params=values or {}).to_arrow_table()


def whole(column: pa.ChunkedArray) -> pa.Array:
    """One array; a slice's results fit in it."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and the bytes of all words, one after another."""
    words = pa.concat_arrays([words.cast(pa.large_binary())])
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    return np.diff(ends), data


def slices(size, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about `most` together; a larger one stands alone."""
    at, held = 0, 0
    for i, n in enumerate(size):
        if i > at and held + n > most:
            yield at, i
            at, held = i, 0
        held += int(n)
    if at < len(size):
        yield at, len(size)


def contract(tables: Tables, words: pa.Array) -> list[pa.Table]:
    """(word, pos, token) rows of all words' ids; words are numbered as they stand."""
    size, data = _bytes_of(words)
    if len(data):
        tables.con.register("merges", tables.merges_for(data))
    number = np.arange(len(words), dtype=np.int64)
    done = []
    for long in (False, True):
        chosen = (size > LONG) == long
        if not chosen.any():
            continue
        inside = np.repeat(chosen, size)
        place = (np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size))[inside]
        tokens = pa.table({"word": np.repeat(number, size)[inside], "pos": place, "token": tables.byte_ids[data[inside]]})
        while tokens.num_rows:
            tables.con.register("tokens", tokens)
            rounds = LONG_ROUNDS if long else ROUNDS
            step = arrow(tables.con, CONTRACT_LONG if long else CONTRACT, {"rounds": rounds})
            # What used up its rounds goes on from where it stands; the steps before need not be kept.
            done.append(step.filter(pa.compute.less(step["step"], rounds)).select(["word", "pos", "token"]))
            tokens = step.filter(pa.compute.equal(step["step"], rounds)).select(["word", "pos", "token"])
    return done


def contract_lists(tables: Tables, words: list[bytes]) -> list[list[int]]:
    found = []
    for low, high in slices([len(w) for w in words], BATCH_BYTES):
        tables.con.register("ready", pa.concat_tables(contract(tables, pa.array(words[low:high], pa.binary()))))
        found += arrow(tables.con, "SELECT list(token ORDER BY pos) AS ids FROM ready GROUP BY word ORDER BY word")["ids"].to_pylist()
    return found


def code_in_blocks(tables: Tables, word: bytes, tokens_of: dict[int, bytes]) -> list[int]:
    """Ids of a very long word: blocks are encoded by themselves, then what stands at their seams again.

    A row of tokens is the encoding of its bytes if every two neighbours are the encoding of theirs: a first
    contraction across a border would happen in the two neighbours alone as well. So seams that fail are encoded
    anew with twice the tokens about them, until none fails.
    """
    ids = [i for block in contract_lists(tables, [word[at : at + LONG] for at in range(0, len(word), LONG)]) for i in block]
    ends = np.cumsum([len(tokens_of[i]) for i in ids])
    seams = [int(i) for i in np.flatnonzero(ends % LONG == 0) if i + 1 < len(ids)]
    reach = 4
    while seams:
        pairs = sorted({(ids[i], ids[i + 1]) for i in seams})
        found = contract_lists(tables, [tokens_of[a] + tokens_of[b] for a, b in pairs])
        fails = {pair for pair, now in zip(pairs, found) if tuple(now) != pair}
        windows: list[list[int]] = []
        for i in seams:
            if (ids[i], ids[i + 1]) in fails:
                low, high = max(0, i + 1 - reach), min(len(ids), i + 1 + reach)
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = high
                else:
                    windows.append([low, high])
        if not windows:
            break
        anew = contract_lists(tables, [b"".join(tokens_of[i] for i in ids[low:high]) for low, high in windows])
        out, at, seams = [], 0, []
        for (low, high), now in zip(windows, anew):
            out += ids[at:low]
            seams += [len(out) - 1, len(out) + len(now) - 1]
            out += now
            at = high
        ids = out + ids[at:]
        seams = sorted({i for i in seams if 0 <= i < len(ids) - 1})
        reach *= 2
    return ids


def code_words(tables: Tables, words: pa.Array) -> None:
    """Encode distinct pieces and note their ids in `coded`."""
    size, _ = _bytes_of(words)
    usual = words.filter(pa.array(size <= VERY_LONG))
    if len(usual):
        tables.con.register("ready", pa.concat_tables(contract(tables, usual)))
        tables.con.register("named", pa.table({"word": np.arange(len(usual)), "piece": usual}))
        tables.con.execute("INSERT INTO coded SELECT piece, ids FROM (SELECT word, list(token ORDER BY pos) AS ids FROM ready GROUP BY word) JOIN named USING (word)")
    if len(usual) < len(words):
        vocabulary = arrow(tables.con, "SELECT id, token FROM vocabulary")
        tokens_of = dict(zip(vocabulary["id"].to_pylist(), vocabulary["token"].to_pylist()))
        for word in words.filter(pa.array(size > VERY_LONG)).to_pylist():
            ids = code_in_blocks(tables, word.encode(), tokens_of)
            tables.con.register("named", pa.table({"piece": [word], "ids": pa.array([ids], pa.list_(pa.int64()))}))
            tables.con.execute("INSERT INTO coded SELECT piece, ids FROM named")


def encode_slice(tables: Tables, texts: pa.Array) -> pa.Array:
    """Token ids of some texts; ids of chunks and pieces that were seen before are looked up."""
    tables.con.register("texts", pa.table({"row": np.arange(len(texts)), "text": texts}))
    tables.con.execute(
        f"""CREATE OR REPLACE TEMP TABLE chunks AS SELECT row, unnest(c) AS chunk, generate_subscripts(c, 1) AS n
            FROM (SELECT row, regexp_extract_all(text, '{CHUNK}') AS c FROM texts)"""
    )
    tables.con.execute("CREATE OR REPLACE TEMP TABLE fresh_chunks AS SELECT DISTINCT chunk FROM chunks ANTI JOIN known USING (chunk)")
    tables.con.execute(f"CREATE OR REPLACE TEMP TABLE parts AS SELECT chunk, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n FROM ({PIECES})", {"piece": PIECE})
    tables.con.execute(
        """CREATE OR REPLACE TEMP TABLE fresh_pieces AS SELECT piece, encode(piece) AS token FROM (SELECT DISTINCT piece FROM parts) ANTI JOIN coded USING (piece)"""
    )
    # A piece that is a token is that token.
    tables.con.execute("INSERT INTO coded SELECT piece, [id] FROM fresh_pieces JOIN vocabulary USING (token)")
    words = whole(arrow(tables.con, "SELECT piece FROM fresh_pieces ANTI JOIN vocabulary USING (token)")["piece"])
    for low, high in slices(_bytes_of(words)[0], BATCH_BYTES):
        code_words(tables, words.slice(low, high - low))
    tables.con.execute("INSERT INTO known SELECT chunk, flatten(list(ids ORDER BY n)) FROM parts JOIN coded USING (piece) GROUP BY chunk")
    # Every chunk with the place of its ids: lists are put together in Arrow, in the chunks' order.
    known = whole(arrow(tables.con, "SELECT ids FROM known ORDER BY rowid")["ids"])
    found = arrow(tables.con, "SELECT c.rowid AS at, c.row, k.rowid AS place FROM chunks c JOIN known k USING (chunk)")
    order = np.argsort(found["at"].to_numpy(), kind="stable")
    places = arrow(tables.con, "SELECT rowid AS place FROM known ORDER BY rowid")["place"].to_numpy()
    row, lists = found["row"].to_numpy()[order], known.take(pa.array(np.searchsorted(places, found["place"].to_numpy()[order])))
    if len(known) > KNOWN:
        tables.con.execute("DELETE FROM known")
        tables.con.execute("DELETE FROM coded")
    size = np.bincount(row, weights=pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), minlength=len(texts))
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), lists.flatten())


def encode_long(tables: Tables, text: str) -> pa.Array:
    """Token ids of one text of any length, cut where white space begins behind a word: no piece reaches over that."""
    parts, at = [], 0
    while at < len(text):
        cut = _BORDER.search(text, at + SLICE_BYTES // 4)
        until = cut.start() if cut else len(text)
        parts.append(encode_slice(tables, pa.array([text[at:until]], pa.large_string())).flatten())
        at = until
    return pa.ListArray.from_arrays(pa.array([0, sum(map(len, parts))], pa.int32()), pa.concat_arrays(parts))


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """The same rows and columns and `ids`, array<int>, as ordinary text without special tokens.

    Null text is empty and has no ids. Every row is encoded whole; repeated rows get equal ids. A text is in
    memory at once, as any string in a row is. An empty table gives no rows. A column already called `ids` is
    replaced. Raises where the vocabulary lacks a byte that occurs.
    """
    lines = read_vocabulary(vocabulary)
    rest = docs.drop(ids)
    column = fresh(rest, "_text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for batch in batches:
            tables = tables or open_tables(lines, True)
            texts = batch.column(batch.num_columns - 1).cast(pa.large_string())
            size = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
            for low, high in slices(size, SLICE_BYTES):
                if size[low] > SLICE_BYTES:
                    found = encode_long(tables, texts[low].as_py())
                else:
                    found = encode_slice(tables, texts.slice(low, high - low))
                if found.flatten().to_numpy().min(initial=0) < 0:
                    raise ValueError("the vocabulary lacks a byte")
                held = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*held.columns[:-1], found], names=[*batch.schema.names[:-1], ids])

    schema = T.StructType([*rest.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return rest.select(*[f"`{c}`" for c in rest.columns], text_or_empty(f"`{text}`").alias(column)).mapInArrow(encode, schema)


def decode_ids(rows: DataFrame, vocabulary: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """The same rows and columns and `decoded`, the bytes of the ids in order (binary).

    Null ids, and no ids, are no bytes. An id that the vocabulary lacks, or a null one, raises. A column already
    called `decoded` is replaced.
    """
    lines = read_vocabulary(vocabulary)
    rest = rows.drop(decoded)
    column = fresh(rest, "_ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = None
        for batch in batches:
            con = con or open_tables(lines, False).con
            lists = batch.column(batch.num_columns - 1)
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            for low, high in slices(size, SLICE_BYTES // 4):
                con.register("coded", pa.table({"row": np.arange(high - low), "ids": lists.slice(low, high - low)}))
                found = arrow(
                    con,
                    """SELECT row, unhex(string_agg(hexed, '')) AS bytes, count(*) = count(hexed) AS known FROM (
                         SELECT row, hexed FROM (SELECT row, unnest(ids) AS id, generate_subscripts(ids, 1) AS n FROM coded)
                         LEFT JOIN vocabulary USING (id) ORDER BY row * 4294967296 + n) GROUP BY row""",
                )
                if not all(found["known"].to_pylist()):
                    raise ValueError("an id is not in the vocabulary")
                place = np.full(high - low, -1)
                place[found["row"].to_numpy()] = np.arange(found.num_rows)
                bytes_ = whole(found["bytes"].cast(pa.binary())).take(pa.array(place, mask=place < 0))
                held = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.compute.fill_null(bytes_, b"")], names=[*batch.schema.names[:-1], decoded])

    schema = T.StructType([*rest.schema.fields, T.StructField(decoded, T.BinaryType())])
    return rest.select(*[f"`{c}`" for c in rest.columns], F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias(column)).mapInArrow(decode, schema)


def encoding_digest(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them, for every row."""
    coded = encode_texts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), vocabulary).select("doc_id", "token_ids")
    return decode_ids(coded, vocabulary).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("token_ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )
