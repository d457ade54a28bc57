"""Periodic runs, byte-level BPE and conversation repair against brute force, and their odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tidemark.llm import byte_bpe, conversation_repair, periodic_runs

JOBS = spark_entry.queries()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (None, None), (4, "same same"), (4, "same same"), (5, "é\x00 </s>\x85x"), (6, "x " * 60_000)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_docs(spark, rows=ODD):
    extra = ("runs", "collapsed", "token_ids", "decoded", "_text", "_words", "_ids", "words", "row", "n", "start")
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in extra})


# Periodic runs ----------------------------------------------------------------------------------------------


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + r] for k in range(i, i + length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_run_row(doc_id, text, plant=True):
    w, n = WORD.findall(text or ""), len(WORD.findall(text or ""))
    h = zlib.crc32(str("null" if doc_id is None else doc_id).encode())
    g = h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *best, milli, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_find_runs_on_random_words():
    rng = random.Random(5)
    for _ in range(800):
        n, letters = rng.randint(0, 80), rng.choice([1, 2, 3, 5])
        w = [rng.randrange(letters) for _ in range(n)]
        if n > 10:
            p, s = rng.randint(1, 12), rng.randint(0, n - 5)
            for i in range(s + p, rng.randint(s, n)):
                w[i] = w[i - p]
        assert list(zip(*(x.tolist() for x in periodic_runs.find_runs(np.array(w, dtype=np.int64))))) == brute_runs(w)


def test_periodic_runs_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(WORD.findall(r["text"] or "")) < 900]
    found = {r["doc_id"]: tuple(r)[1:] for r in JOBS["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(rows) > 100 and any(r[0] for r in found.values())
    assert {r["doc_id"]: found[r["doc_id"]] for r in rows} == {r["doc_id"]: brute_run_row(r["doc_id"], r["text"]) for r in rows}


def test_periodic_runs_on_odd_rows(spark):
    frame = periodic_runs.periodic_runs(odd_docs(spark))
    assert dict(frame.dtypes)["start"] == "string" and dict(frame.dtypes)["collapsed"] == "string"
    found = sorted((tuple(r) for r in periodic_runs.runs_digest(frame).collect()), key=repr)
    assert found == sorted(((i, *brute_run_row(i, t if i != 6 else "", plant=False)) if i != 6 else
                            (6, 1, 0, 60_000, 1, 60_000_000, sha("0,60000,1\n"), sha("x")) for i, t in ODD), key=repr)
    assert periodic_runs.runs_digest(periodic_runs.periodic_runs(odd_docs(spark, []))).count() == 0
    lists = spark.createDataFrame([(1, ["a", None, "a"] * 4), (2, None), (3, [])], "doc_id long, words array<string>")
    assert [(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in periodic_runs.periodic_runs(lists, F.col("words")).orderBy("doc_id").collect()] == [(1, 1, "a"), (2, 0, ""), (3, 0, "")]


def test_planted_runs_on_odd_rows(spark):
    """Texts without words, of which some are told to get a run, stay empty."""
    rows = [(i, t) for i in range(40) for t in (None, "", " \t\n")] + [(None, None), (None, "a b c d e f g"), (7, "a b c d e f g")]
    words = periodic_runs.planted_words(odd_docs(spark, rows))
    found = sorted((tuple(r) for r in periodic_runs.runs_digest(periodic_runs.periodic_runs(words, F.col("words"))).collect()), key=repr)
    assert found == sorted(((i, *brute_run_row(i, t)) for i, t in rows), key=repr)


def test_runs_do_not_cross_rows_and_slices(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 10)
    rows = [(i, "a b " * (i % 4)) for i in range(1, 60)]
    found = {r["doc_id"]: tuple(r)[1:] for r in periodic_runs.runs_digest(periodic_runs.periodic_runs(odd_docs(spark, rows).coalesce(1))).collect()}
    assert found == {i: brute_run_row(i, t, plant=False) for i, t in rows}


# Byte-level BPE ---------------------------------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.parse_vocabulary(byte_bpe.read_vocabulary(PATH))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tables():
    return byte_bpe.open_tables(byte_bpe.read_vocabulary(PATH), True)


def brute_coding(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids))), hashlib.sha256((text or "").encode()).hexdigest()


def test_encoding_query(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in JOBS["op13_byte_bpe"](spark, sf_dir).collect()}
    assert found == {r["doc_id"]: brute_coding(library, r["text"]) for r in rows}


def test_encoding_of_odd_rows(spark, library):
    frame = byte_bpe.decode_ids(byte_bpe.encode_texts(odd_docs(spark), PATH), PATH)
    for r in frame.collect():
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode() and r["_text"] == "clash"
    assert frame.count() == len(ODD)
    assert byte_bpe.encoding_digest(odd_docs(spark, []), PATH).count() == 0
    nothing = spark.createDataFrame([(None,), ([],)], "token_ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode_ids(nothing, PATH).collect()] == [b"", b""]
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode_ids(spark.createDataFrame([([50256],)], "token_ids array<int>"), PATH).collect()


def test_classes_are_the_librarys(library, tables):
    every = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    for pattern, ours in ((r"\p{L}+", byte_bpe.LETTER), (r"\p{N}+", byte_bpe.NUMBER), (r"\s+", byte_bpe.SPACE)):
        theirs = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = byte_bpe.arrow(tables.con, f"SELECT array_to_string(regexp_extract_all($text, '[{ours}]+'), '') AS t", {"text": every})["t"][0].as_py()
        assert found == theirs.decode(theirs.encode_ordinary(every))


def test_pieces_are_cut_as_the_library_cuts_them(library, tables):
    marks = ["a", "é", "\U00010d4a", "1", "²", "'", "'s", "'ll", "-", " ", "  ", "\n", "\t", "\u3000", "\x85", "\x1f", "\x00"]
    texts = ["".join(m) for n in (1, 2, 3) for m in itertools.product(marks, repeat=n)]
    assert byte_bpe.encode_slice(tables, pa.array(texts, pa.large_string())).to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_long_words(library, tables):
    rng = random.Random(2)
    words = ["a" * n for n in (63, 64, 65, 1023, 1024, 1025, 5000)] + ["na" * 2001, "the" * 1000, " " * 3000, "=" * 700, "é" * 900]
    words += ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "abcdefgh", "etaoin", "ABCxyz") for n in (70, 900, 1100, 4000)]
    assert byte_bpe.encode_slice(tables, pa.array(words, pa.large_string())).to_pylist() == [library.encode_ordinary(w) for w in words]


def test_long_texts_are_cut_between_pieces(monkeypatch, library, tables):
    monkeypatch.setattr(byte_bpe, "SLICE_BYTES", 40)
    text = "one  two\n\n\u3000three \x1f four's  five \x85six " * 30 + "  "
    assert byte_bpe.encode_long(tables, text).to_pylist() == [library.encode_ordinary(text)]


def test_looking_up_forgets_in_time(monkeypatch, library, tables):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    for n in range(6):
        text = " ".join(f"wörd{n}x{i}" for i in range(n))
        assert byte_bpe.encode_slice(tables, pa.array([text, "", text])).to_pylist() == [library.encode_ordinary(t) for t in (text, "", text)]


# Conversation repair ----------------------------------------------------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(symbols):
    """The least (cost, audit) by a plain program over rows: symbols are (initial, fault)."""
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def inserted(ways):
        for _ in range(3):
            for (i, initial), j in steps.items():
                if initial in "ua" and i in ways:
                    way = (ways[i][0] + 3, ways[i][1] + "I")
                    ways[j] = min(ways.get(j, way), way)
        return ways

    ways = inserted({0: (0, "")})
    for initial, fault in symbols:
        after = {}
        for i, (cost, audit) in ways.items():
            options = [(i, cost + 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                options += [(j, cost + more, "K") for (at, wanted), j in steps.items() if at == i and wanted == initial]
                options += [(j, cost + more + 3, "R") for (at, wanted), j in steps.items() if at == i and wanted in "ua"]
            for j, total, letter in options:
                way = (total, audit + letter)
                after[j] = min(after.get(j, way), way)
        ways = inserted(after)
    return min(ways[j] for j in (0, 3) if j in ways)


def brute_repair(rows, damage=True):
    every = {r[0] for r in rows}
    by_conv = {c: [] for c in every}
    for r in damaged(rows) if damage else [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]:
        by_conv[r[0]].append(r)
    found = {}
    for conv, members in by_conv.items():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, symbols = set(), []
        for _, _, role, text in members:
            body = text.strip(BLANK)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            symbols.append((role[:1] if role[:1] in tuple("sua") else "?", fault))
        turns = [r[1] for r in members if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, f in symbols]
        initials = [r[2][:1] for r in members]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(symbols)
        lines, state, left = [], "", iter(members)
        for letter in audit:
            row = next(left) if letter != "I" else None
            if letter != "D":
                role = row[2] if letter == "K" else "assistant" if state == "u" else "user"
                lines.append(f"{role}:{row[3] if row else ''}")
                state = role[0]
        assert GOOD.fullmatch("".join(line[0] for line in lines))
        found[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))
    return found


def test_conversation_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r)[1:] for r in JOBS["op11_conversation_repair"](spark, sf_dir).collect()}
    assert found == brute_repair(rows)


def odd_turns(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "umpire"]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why? ", "x" * 70_000 + ".", "é!"]
    return [
        (rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([None, *range(12), 40]), rng.choice(roles), rng.choice(texts)) for _ in range(n)
    ]


@pytest.mark.parametrize("piece", [1, 3, 256])
def test_conversation_repair_on_odd_rows(spark, piece):
    rows = odd_turns(piece, 120) + [(9, None, "user", "Hi.")] * 30 + [(8, i, "ua"[i % 2] + "x", f"{i}.") for i in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    turns = turns.withColumns({c: F.lit("clash") for c in ("place", "piece", "sequence", "audit", "state", "cost", "salt", "first", "nth", "copy", "kind")})
    summaries, repaired, digests = conversation_repair.repair_conversations(turns, piece=piece)
    digest = {r["conv_id"]: r["repaired_sha256"] for r in digests.collect()}
    found = {r["conv_id"]: (*tuple(r)[1:], digest.get(r["conv_id"], sha(""))) for r in summaries.collect()}
    assert found == brute_repair(rows, damage=False)
    lines = {}
    for r in repaired.orderBy("conv_id", "piece", "nth").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: sha("\n".join(v)) for c, v in lines.items()} == digest
    assert {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_digest(turns).collect()} == brute_repair(rows)


def test_conversation_repair_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert [f.count() for f in conversation_repair.repair_conversations(turns)] == [0, 0, 0]
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in conversation_repair.repair_digest(turns).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_rules_are_shared_and_change_nothing(spark):
    rng = random.Random(4)
    sequences = sorted({"".join(rng.choice("aeim") for _ in range(rng.randint(1, 30))) + "f" * rng.choice([0, 40]) for _ in range(300)})
    rules = conversation_repair.learn_grammar(spark.createDataFrame([(s,) for s in sequences], "sequence string"), a_round=4)
    assert len(rules) > 8 and any(ord(left) >= 0xE000 for left, _ in rules)
    plain, ruled = ({r["sequence"]: (r["cost"], r["audit"]) for r in conversation_repair.work_out(spark.createDataFrame([(s,) for s in sequences], "sequence string"), g).collect()} for g in ([], rules))
    assert plain == ruled
