"""The dealt operators: SQL or brute force on given tables, and defined results on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from oracle import compare, connect
from tidemark.llm import chat_format, decontaminate, langid, licenses, minhash, mixing, quality, secret_scan, suffix_dedup, vector_dedup
from tidemark.llm.components import components

JOBS, SQL = spark_entry.queries(), spark_entry.oracle_sql()
DOCS = "doc_id long, text string, source string, lang string, n_chars long"
P = "one two three four five six seven eight nine ten eleven twelve"
ODD = [
    (1, None, None, None, None), (2, "", "a", "en", 0), (3, " \t\n", "a", None, 3), (None, P, "b", "en", 1), (None, None, None, None, None),
    (4, P, "b", "en", 1), (4, P, "b", "en", 1), (5, P.upper(), "b", "en", 1), (6, "x " * 60_000, "b", "en", 1),
    (7, "é\x00 </s> token = abcdefgh1234", "a", "fr", 1), (8, "ab", "c", "en", 2),
]


def docs(spark, rows=ODD):
    """With columns whose names clash with the operators' own."""
    extra = ("kept", "size", "key", "score", "hits", "spans", "path", "blob", "rep", "label", "n", "bucket", "w", "_spans", "component")
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in extra})


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect() if r["doc_id"] is not None}


@pytest.mark.parametrize("name", sorted(n for n in SQL if re.match(r"op\d", n)))
def test_against_sql(spark, sf_dir, name):
    problem, _ = compare(connect(sf_dir), JOBS[name](spark, sf_dir), SQL[name])
    assert problem is None


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    return {i: (len(sets[i]), least[i]) for i in sets}


def test_near_duplicates_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = JOBS["op2_minhash_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_near(rows)


def test_near_duplicates_of_ids_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(1, a), (1, b), (2, f"{a} z"), (3, f"{b} z"), (4, " ".join(f"c{i}" for i in range(9))), (0, b)]
    found = [(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs(spark, [(*r, None, None, None) for r in rows])).collect()]
    assert sorted(found) == [(0, 0), (1, 0), (1, 0), (2, 0), (3, 0), (4, 4)]


def test_bounds_of_the_quality_fit_hold_for_repeated_ids(spark, monkeypatch):
    rows = [(1, f"good text number {i % 50}.", None, None, None) for i in range(300)] + [(i, f"other {i}", None, None, None) for i in range(2, 90)]
    sizes = []
    monkeypatch.setattr(quality, "fit_nnpu", lambda p, u, prior: sizes.append((len(p), len(u))))
    given = docs(spark, rows).select("doc_id", "text", F.lit(False).alias("held_out"))
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(1, 90)], "doc_id long, quality int")
    quality.fit(given, labels, positives=10, unlabelled=20)
    quality.fit(given, labels, positives=1000, unlabelled=1000)
    assert sizes[0] == (10, 20) and sizes[1][1] == 50 + 88


def test_near_duplicate_chain_of_edits(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):  # a drifting text: neighbours are alike, the ends are not
        words[i * 3] = f"z{i}"
        rows.append((i + 10, " ".join(words), None, None, None))
    found = by_id(minhash.near_duplicates(docs(spark, rows + ODD)))
    want = brute_near([(r[0], r[1]) for r in rows + ODD if r[0] is not None])
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == want
    assert want[69][1] == 10


def brute_removal(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if (window := data[k : k + 100]) in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = JOBS["op3_suffix_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == brute_removal(rows)


def test_repeats_across_runs_and_in_periodic_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", 7)  # every anchor of the common passage needs several runs
    passage = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(3))
    rows = [(i, f"{hashlib.md5(str(i).encode()).hexdigest() * (i % 3)}{passage}{i}", None, None, None) for i in range(40)]
    rows += [(100, "abc " * 100, None, None, None), (101, "x" * 99, None, None, None), (102, "x" * 300, None, None, None), (103, None, None, None, None)]
    found = by_id(suffix_dedup.removal_digest(suffix_dedup.remove_repeats(docs(spark, rows))))
    assert {i: tuple(r)[1:] for i, r in ((i, (r["doc_id"], *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])) for i, r in found.items())} == brute_removal([r[:2] for r in rows])


def test_texts_of_one_id_keep_their_own_spans(spark):
    # Two texts of one id whose 64-bit digests end in the same 24 bits: only one of them repeats anything.
    import xxhash

    passage = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(4))
    seen, pair = {}, None
    for i in range(1_000_000):
        text = "".join(hashlib.md5(f"{i}-{k}".encode()).hexdigest() for k in range(9)) if i % 2 else f"{i}{passage}"
        tail = xxhash.xxh64_intdigest(text.encode(), seed=42) & 0xFFFFFF
        if seen.get(tail, i) % 2 != i % 2:
            other = seen[tail]
            pair = [text, "".join(hashlib.md5(f"{other}-{k}".encode()).hexdigest() for k in range(9)) if other % 2 else f"{other}{passage}"]
            break
        seen[tail] = i
    assert pair
    repeating, alone = sorted(pair, key=lambda t: passage not in t)
    for ids in ((1, 2, 2), (1, None, None)):
        rows = [(i, t, None, None, None) for i, t in zip(ids, (passage, repeating, alone))]
        found = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in suffix_dedup.removal_digest(suffix_dedup.remove_repeats(docs(spark, rows))).collect()}
        assert found[ids[1], len(repeating)] == len(passage) and found[ids[2], len(alone)] == 0


def test_repeated_rows_count_once_for_repeats(spark):
    passage = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(4))
    # Equal segments, and segments that share an anchor with others, in rows that stand there up to three times.
    rows = [(1, passage, None, None, None)] * 3 + [(2, f"{passage[:180]}!{'tail ' * 9}", None, None, None)] * 2
    rows += [(3, f"head {passage[20:210]}?", None, None, None), (4, "x" * 150, None, None, None), (4, "x" * 150, None, None, None)]
    found = suffix_dedup.removal_digest(suffix_dedup.remove_repeats(docs(spark, rows))).collect()
    expected = brute_removal({r[:2] for r in rows})
    assert expected[1][1] == 0 and expected[2][1] > 0
    assert sorted(map(tuple, found)) == sorted((r[0], *expected[r[0]]) for r in rows)


def test_vectors_on_planted_links_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 16))
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(base)]
    rows += [(1000 + i, (v + rng.standard_normal(16) * 0.15).tolist(), int(i % 2)) for i, v in enumerate(base)]
    rows += [(2000, base[0].tolist(), 0), (2001, (base[0] * 3).tolist(), 0), (2002, base[0].tolist(), None), (2003, None, 0), (2004, [0.0] * 16, 0)]
    rows += [(2005, [float("nan")] * 16, 0), (2006, [None] * 16, 0), (2007, [], 0), (2008, [1.0, 2.0], 0), (None, base[0].tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    good = {i: (np.array(e), g) for i, e, g in rows if i is not None and i < 2002}
    links = Counter()
    for (a, (x, g)), (b, (y, h)) in itertools.combinations(good.items(), 2):
        if g == h and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
            links[a] += 1
            links[b] += 1
    found = {r["vec_id"]: r for r in vector_dedup.similar_vectors(frame).collect()}
    assert len(found) == len(rows)
    assert sum(links.values()) > 100
    assert sum(r["n_links"] for r in found.values()) >= 0.99 * sum(links.values())
    assert all(r["n_links"] <= links[i] for i, r in found.items())
    assert found[2001]["component_id"] == 0 and found[2002]["kept"] and found[2005]["n_links"] == 0


def test_parted_cells_find_the_same_links(spark, sf_dir, monkeypatch):
    want = sorted(JOBS["op5_vector_dedup"](spark, sf_dir).collect())
    monkeypatch.setattr(vector_dedup, "BLOCK", 5)
    assert sorted(JOBS["op5_vector_dedup"](spark, sf_dir).collect()) == want


def test_recall_parameters():
    half, count = vector_dedup.window_and_count(0.98)
    assert half == 500 and 18 <= count <= 22


def test_components_of_a_path(spark):
    edges = spark.range(100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r["node"], r["component"]) for r in components(edges, "a", "b").collect()} == {(i, 0) for i in range(101)}
    assert components(edges.where("a < 0"), "a", "b").count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\|im_end|>\\", "<|im_sep|>", "", None, "[\\INST]<", "|im_end|>", "a\nb\n", "\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(None, None, None, None), (2, 0, "<|im_end|>", "x"), (2, 0, "<|im_end|>", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    found = {r["conv_id"]: r for r in chat_format.format_conversations(frame).collect()}
    assert all(r["round_trip"] for r in found.values()) and len(found) == 3
    assert [t["text"] for t in found[1]["recovered"]] == [t or "" for t in nasty]
    masked, at = [], 0
    for run in found[1]["loss_runs"]:
        masked.append(found[1]["formatted"][at + run["skipped"] : at + run["skipped"] + run["learned"]])
        at += run["skipped"] + run["learned"] + run["skipped_after"]
    assert at == len(found[1]["formatted"])
    assert masked[1] == "<\\\\/s>" and masked[3] == "<\\|im_sep|>"
    with pytest.raises(ValueError):
        chat_format.ChatTemplate(opens="<<x>")


def test_ledger_scans_unseen_blobs_only(spark):
    first = docs(spark)
    findings, ledger = secret_scan.scan_versions(first)
    assert [s["kind"] for s in by_id(findings.withColumnRenamed("path", "doc_id"))[7]["spans"]] == ["assign"]
    known = spark.createDataFrame(ledger.collect(), ledger.schema)
    again, added = secret_scan.scan_versions(first, known)
    assert added.count() == 0 and sorted(map(str, again.collect())) == sorted(map(str, findings.collect()))
    assert secret_scan.scan_versions(first, known, rules_version="2")[1].count() == known.count()
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(first).collect()}
    assert clean[7] == "é\x00 </s> [SECRET]" and clean[4] == P and clean[1] is None


def test_windows_of_short_items_and_odd_documents(spark):
    items = spark.createDataFrame([(10, "Two THREE"), (9, P), (8, None), (7, "absent words here"), (None, "ab")], "item_id long, text string")
    found = by_id(decontaminate.contamination(docs(spark), items))
    assert found[4]["n_hit"] == 12 and found[4]["items_sha256"] == hashlib.sha256(b"10,9").hexdigest()
    assert found[5]["contaminated"] and not found[1]["contaminated"] and found[8]["n_items"] == 0 and found[8]["n_hit"] == 1
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs(spark), items.where("false")).collect())


def test_licenses_on_lines(spark):
    rows = [(1, "x\n// Released under the  MIT License!\ny", "a", "en", 1), (2, None, "a", "en", 1), (3, "the MIT License", "a", "en", 1)]
    found = by_id(licenses.license_digest(licenses.scan_licenses(docs(spark, rows))))
    assert (found[1]["licenses"], found[1]["lines"], found[2]["licenses"], found[3]["n_matches"]) == ("mit", "2:mit", "", 0)


def test_licenses_off_lines(spark):
    wrapped = "\n\nint x;\n * Use of this source code is governed by a BSD-style\n * license that can be found in the LICENSE file.\n"
    bodies = dict(licenses.TEXTS)
    body = "Copyright 2020 Acme\n\n" + re.sub(r"((?:\S+ ){9})", r"\1\n# ", bodies["mit"])
    both = "(c) 2020 Acme. Released under the MIT License. Licensed under CC BY-NC 4.0. All rights reserved."
    gpl = "x\nThis work is licensed under the GNU General Public License, version 2.\nThis work is licensed under the GNU General Public\nLicense, version 3."
    rows = [(i, t, "a", "en", 1) for i, t in enumerate(("(c) 2020 Acme. Released under the MIT License.", wrapped, body, both, gpl, "word " * 3000 + bodies["isc"]), 1)]
    found = by_id(licenses.license_digest(licenses.scan_licenses(docs(spark, rows))))
    assert [found[i]["lines"] for i in range(1, 7)] == ["1:mit", "4:bsd-3-clause", "3:mit", "1:mit,1:cc-by-nc-4.0", "2:gpl-2.0,3:gpl-3.0", "1:isc"]
    assert all(found[i]["best_dice"] == 1 for i in (1, 2, 3, 4, 5, 6))


def test_mixing_targets_and_bounds(spark):
    rows = mixing.mix_documents(docs(spark)).collect()
    assert len(rows) == len(ODD)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert sorted(map(str, mixing.mix_documents(docs(spark).repartition(5)).collect())) == sorted(map(str, rows))


def test_classifiers_hold_out(spark, sf_dir):
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = JOBS["op10_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(truth, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found) > 0
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = JOBS["op9_quality_pu"](spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean(np.array(good) >= 0.5) > 0.95


def test_classifiers_on_odd_rows(spark):
    rows = {r["doc_id"]: r for r in langid.identify(docs(spark)).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and rows[8]["lang_pred"] in ("en", "fr")
    labels = spark.createDataFrame([(2, 1), (2, 0), (4, 1), (5, None), (None, 1), (99, 1)], "doc_id long, quality int")
    scored = quality.classify(docs(spark), labels).collect()
    assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
    assert all(r["score"] == 0.5 for r in quality.classify(docs(spark), labels.where("false")).collect())


def test_empty_tables(spark):
    none = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for found in (
        minhash.near_duplicates(none), suffix_dedup.remove_repeats(none), mixing.mix_documents(none), licenses.scan_licenses(none),
        secret_scan.scan_versions(none)[0], decontaminate.contamination(none, none.withColumnRenamed("doc_id", "item_id")),
        quality.classify(none, labels), langid.identify(none),
        vector_dedup.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")),
    ):
        assert found.count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in now.select("doc_id").collect()}
        now = spark.createDataFrame(stage(spark, now, sf_dir).collect(), now.schema)
        assert now.columns == columns and {r["doc_id"] for r in now.select("doc_id").collect()} <= before, name
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    assert len(set(texts.values())) == len(texts)
    final = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert {r["doc_id"] for r in final} == set(texts)
    odd = docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() > 0, name
        assert stage(spark, odd.limit(0), sf_dir).count() == 0, name


def test_pipeline_stages_judge_rows_by_their_own_text(spark, sf_dir):
    import corpus_pipeline

    item = max((r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()), key=len)
    clean = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(None, item), (None, clean[0]), (7, item), (7, clean[1]), (8, clean[1]), (None, clean[1]), (None, clean[2]), (None, clean[2]), (9, None)]
    given = docs(spark, [(*r, "s", "en", 1) for r in rows])
    left = corpus_pipeline.decontamination_stage(spark, given, sf_dir).select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, [r for r in rows if r[1] != item]))
    left = corpus_pipeline.near_duplicate_stage(spark, given, sf_dir).select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, [(7, item), (None, clean[0]), (7, clean[1]), (None, clean[2]), (9, None)]))


@pytest.mark.parametrize("weight", [0.05, 1.0, 0.001, 30.0])
def test_no_cell_of_keys_is_crowded(spark, weight):
    keys = spark.range(20_000).select((-F.log(F.rand(5)) / weight).alias("key"))
    cells = keys.select(mixing.key_cell(F.col("key"), 4096).alias("cell"), "key").groupBy("cell").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("cell").collect()
    assert max(r["n"] for r in cells) < 400 and all(a["hi"] <= b["lo"] for a, b in zip(cells, cells[1:]))
