"""Operators 1, 2, 3 and 8 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from tarnhouse.llm import suffix_array as sa
from tarnhouse.llm.components import components
from tarnhouse.llm.decontamination import contamination_report, decontaminate
from tarnhouse.llm.line_dedup import dedup_lines, line_report
from tarnhouse.llm.near_dedup import alike_in_block, keep_first, near_duplicates, near_report, united_further
from tarnhouse.llm import near_dedup, suffix_dedup
from tarnhouse.llm.near_dedup import Shingles, joined, links_in_block, small_batches, whole_groups
from tarnhouse.llm.suffix_dedup import Bytes, remove_repeats, repeat_report

from .conftest import ROWS, SCHEMA, as_text, by_row, stored

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("limit", [1024, 3, 0])
def test_suffix_array(monkeypatch, limit):
    monkeypatch.setattr(sa, "BY_BUCKET", limit)
    rng = random.Random(5)
    for _ in range(400):
        k = rng.choice([1, 2, 3, 10])
        t = [rng.randint(1, k) for _ in range(rng.randint(0, 40))] + [0]
        s = np.array(t)
        order = sorted(range(len(t)), key=lambda i: t[i:])
        assert sa.suffix_array(s, k + 1).tolist() == order
        most = rng.choice([1, 4, 6, 100])
        common = sa.permuted_common_prefixes(s, np.array(order), most)
        for a, b in zip(order, order[1:], strict=False):
            n = next((i for i in range(most) if max(a, b) + i >= len(t) or t[a + i] != t[b + i]), most)
            assert common[b] == n


def repeats_by_hand(rows, length):
    """Rows in order of id; equal rows are alike, so their order does not matter."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(data), sum(gone), spans, sha(kept)))
    return out


@pytest.mark.parametrize("many", [2000, 0])
def test_repeats(docs, many):
    got = repeat_report(docs, many=many)
    # Two rows have no id; which comes first depends on the scan, so their texts must differ in what they hold.
    want = repeats_by_hand([r[:2] for r in ROWS], 100)
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == as_text(want)
    assert sum(r[2] for r in want) > 2000


@pytest.mark.parametrize("piece", [37, 500])
def test_anchors_do_not_depend_on_pieces(piece):
    """Each anchor is listed once, with all its windows, wherever the pieces end."""
    rng = random.Random(5)
    sizes = np.array([900, 0, 40, 2600, 100, 1500])
    data = bytes(rng.randrange(97, 105) for _ in range(sizes.sum()))
    none = np.zeros(len(sizes), dtype=np.int64)
    whole, cut = (Bytes(none, none, sizes, data, none, p).anchors(100) for p in (1 << 20, piece))
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))
    assert len(np.unique(whole[0])) == len(whole[0]) and (whole[2] >= whole[1]).all()


@pytest.mark.parametrize("many", [2000, 0])
def test_repeats_in_small_blocks_and_pieces(docs, many):
    got = repeat_report(docs, many=many, block_bytes=3000, piece=211)
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == as_text(repeats_by_hand([r[:2] for r in ROWS], 100))


def test_repeats_in_the_given_documents(spark, sf):
    """Whole texts of a given table, in several blocks and many pieces, against brute force."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    got = repeat_report(table, block_bytes=100_000, piece=4099)
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == as_text(repeats_by_hand(rows, 100))


def test_a_new_split_of_the_files_between_steps_changes_nothing(docs, spark, monkeypatch):
    """Rows are numbered once: later steps read the stored numbers, however the files are cut by then."""
    settings = iter(["64b", "10mb"] * 20)
    kept = suffix_dedup.Stored

    def stored_then_split(df, name, packed):
        out = kept(df, name, packed)
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(settings))
        return out

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(suffix_dedup, "Stored", stored_then_split)
    try:
        got = by_row(repeat_report(docs, block_bytes=3000), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == as_text(repeats_by_hand([r[:2] for r in ROWS], 100))


def test_repeats_inside_a_document(spark, tmp_path):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdé ") for _ in range(300))
    rows = [(1, text + text), (2, "ab" * 400), (3, text[50:220] + "#" + text[100:]), (4, "x" + "ab" * 90)]
    df = stored(spark, tmp_path, rows, "doc_id long, text string", "inside")
    got = repeat_report(df)
    assert by_row(got, *got.columns) == as_text(repeats_by_hand(rows, 100))
    spans = {r["doc_id"]: r for r in remove_repeats(df).collect()}
    for doc, text in rows:
        data = text.encode()
        for s in reversed(spans[doc]["removed"]):
            data = data[: s["start"]] + data[s["end"] :]
        assert data == bytes(spans[doc]["kept"])


WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def windows(text):
    words = WORD.findall((text or "").translate(LOW))
    n = min(10, len(words))
    return words, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def contamination_by_hand(rows, items):
    known = [(item, windows(text)[1]) for item, text in items]
    out = []
    for doc, text in rows:
        words, hit, found = windows(text)[0], set(), set()
        for item, grams in known:
            for gram in grams:
                for i in range(len(words) - len(gram) + 1):
                    if tuple(words[i : i + len(gram)]) == gram:
                        hit |= set(range(i, i + len(gram)))
                        found |= {item} - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), sha(ids), bool(hit)))
    return out


ITEM = " ".join(ROWS[9][1].split()[3:18])
ITEMS = [(1, ITEM.upper()), (20, "Two, WORDS!"), (3, None), (4, " ,;"), (None, "a b c d"), (1, ITEM), (5, ROWS[10][1])]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_contamination(spark, docs, broadcast_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination_report(docs, bench, broadcast_bytes=broadcast_bytes)
    want = contamination_by_hand([r[:2] for r in ROWS], ITEMS)
    assert by_row(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == as_text(want)
    assert sum(r[5] for r in want) > 4


def test_contamination_in_a_long_text(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(9000)]
    rows = [(1, " ".join(words))]
    items = [(k, " ".join(words[a : a + 12])) for k, a in enumerate([0, 4086, 4090, 4095, 4096, 8191, 8988])]
    df = stored(spark, tmp_path, rows, "doc_id long, text string", "long")
    got = contamination_report(df, spark.createDataFrame(items, "item_id long, text string"))
    want = contamination_by_hand(rows, items)
    assert by_row(got, *got.columns) == as_text(want)


def test_decontaminate(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = {r[0] for r in contamination_by_hand([r[:2] for r in ROWS], ITEMS) if r[5]}
    whole = decontaminate(docs, bench)
    assert whole.columns == docs.columns
    assert by_row(whole, "doc_id", "text") == as_text([r[:2] for r in ROWS if r[0] not in bad or (r[0] is None and r[1] is None)])
    spans = decontaminate(docs, bench, remove="spans")
    assert spans.count() == len(ROWS) and spans.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in spans.collect()}
    assert left[4] == "" and left[3] == "one" and left[0] is None
    assert left[9] == " ".join(ROWS[9][1].split()[:3] + ROWS[9][1].split()[18:])
    with pytest.raises(ValueError, match="words"):
        decontaminate(docs, bench, remove="words")


def test_empty_benchmark(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination_report(docs, none).where("contaminated").count() == 0
    assert contamination_report(docs, none).count() == len(ROWS)
    assert contamination_report(no_docs, none).count() == 0


def lines_by_hand(rows, min_sites):
    """rows: (doc_id, text, source), in the order that decides which line is first."""
    sites: dict[str, set] = {}
    for _, text, source in rows:
        for raw in text.split("\n") if text is not None else []:
            sites.setdefault(raw.strip(" \t\r"), set()).add(source)
    seen, out = set(), []
    for doc, text, _ in rows:
        kept, gone = [], 0
        for raw in text.split("\n") if text is not None else []:
            line = raw.strip(" \t\r")
            if line and len(sites[line]) >= min_sites and line in seen:
                gone += 1
            else:
                kept.append(raw)
            seen.add(line)
        n = text.count("\n") + 1 if text is not None else 0
        out.append((doc, n, gone, "\n".join(kept), text))
    return out


@pytest.mark.parametrize("min_sites", [2, 4, 8])
def test_lines(docs, min_sites):
    rows = sorted(((r[0], r[1], r[3]) for r in ROWS), key=lambda r: (r[0] is None, r[0] or 0))
    want = lines_by_hand(rows, min_sites)
    got = line_report(docs, min_sites)
    assert by_row(got, *got.columns) == as_text([(d, n, g, sha(k)) for d, n, g, k, _ in want])
    texts = dedup_lines(docs, min_sites)
    assert texts.columns == docs.columns
    assert by_row(texts, "doc_id", "text") == as_text([(d, t if t is None else k) for d, _, _, k, t in want])
    filled = dedup_lines(docs, min_sites, drop_empty=True)
    kept = [(d, t if t is None else k) for d, _, g, k, t in want if not g or k.strip(" \t\r\n")]
    assert by_row(filled, "doc_id", "text") == as_text(kept)
    assert sum(r[2] for r in want) > 0


def shingle_set(text, size=5):
    words = re.findall("[^\\x20\\x09-\\x0D]+", (text or "").translate(LOW))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def groups_by_hand(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return out


@pytest.mark.parametrize(("percent", "small", "depth"), [(85, 24, 5), (60, 2, 2)])
def test_near_duplicates(docs, percent, small, depth):
    got = near_report(docs, percent=percent, small=small, depth=depth)
    want = groups_by_hand([r[:2] for r in ROWS], percent)
    assert by_row(got, "doc_id", "n_shingles", "component_id", "kept") == as_text(want)


def test_one_row_of_each_group(docs):
    first = keep_first(docs, percent=80)
    assert first.columns == docs.columns
    want = groups_by_hand([r[:2] for r in ROWS], 80)
    singles = sum(1 for r in want if not r[1])
    assert first.count() == len({r[2] for r in want if r[1]}) + singles


def test_dense_group_of_near_copies(spark, tmp_path):
    """Copies with one edit each, and pairs that only a few members link to the rest."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        words[k % 120] = f"e{k}"
        if k >= 120:
            words[(k * 7) % 120] = f"f{k}"
        rows.append((k, " ".join(words)))
    drifting = list(base)
    for k in range(150, 170):  # each is near the one before, the last ones far from the first
        drifting[(k * 6) % 120] = f"d{k}"
        rows.append((k, " ".join(drifting)))
    df = stored(spark, tmp_path, rows, "doc_id long, text string", "dense")
    got = near_report(df, small=8, depth=3)
    assert by_row(got, *got.columns) == as_text(groups_by_hand(rows, 85))


def test_components(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).df.collect()}
    near: dict[int, set] = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        reached, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - reached:
                reached.add(other)
                todo.append(other)
        assert got[node] == min(reached)
    assert set(got) == set(near)
    assert components(spark.createDataFrame([], "a long, b long")).df.count() == 0


def test_empty_tables(no_docs):
    assert repeat_report(no_docs).collect() == []
    assert line_report(no_docs).collect() == []
    assert dedup_lines(no_docs, drop_empty=True).collect() == []
    assert near_duplicates(no_docs).collect() == []
    assert keep_first(no_docs).columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_groups_of_mostly_the_same_nodes_are_united(spark):
    groups = {1: range(40), 2: range(5, 45), 3: range(40, 70), 4: range(100, 140)}
    rows = spark.createDataFrame([(p, n) for p, nodes in groups.items() for n in nodes], "path long, node long")
    found = {}
    for r in united_further(rows).df.collect():
        found.setdefault(r["path"], []).append(r["node"])
    united = sorted(sorted(nodes) for nodes in found.values())
    assert united == [list(range(45)), list(range(40, 70)), list(range(100, 140))]
    again = spark.createDataFrame([(p, n) for p in (1, 2, 3) for n in range(9 + (p == 3))], "path long, node long")
    assert sorted(r["node"] for r in united_further(again).df.collect()) == list(range(10))


def test_pairs_of_a_block(spark):
    rng = np.random.default_rng(5)
    node, component = rng.permutation(60), rng.integers(0, 9, 60)
    signature = rng.integers(0, 2, (60, 16)).astype(np.int32)
    want = {
        (min(node[i], node[k]), max(node[i], node[k]))
        for i in range(60)
        for k in range(i)
        if component[i] != component[k] and (signature[i] == signature[k]).sum() >= 9
    }
    found = [p for a, b in alike_in_block(node, component, signature.ravel(), 9, rows=50) for p in zip(a, b, strict=True)]
    assert len(found) == len(want) and set(found) == want


def test_crowd_below_the_threshold_takes_few_jobs(spark, tmp_path, monkeypatch):
    """Copies that are alike in nearly all pairs but hardly linked, in parts that are smaller than their group."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(90):
        words = list(base)
        for at in rng.sample(range(100), 1 + (k % 9 > 0) + (k % 3 > 0)):
            words[at] = f"e{k}x{at}"
        rows.append((k, " ".join(words)))
    df = stored(spark, tmp_path, rows, "doc_id long, text string", "crowd")
    want = as_text(groups_by_hand(rows, 85))
    monkeypatch.setattr(near_dedup, "IN_BLOCK", 16)
    spark.sparkContext.setJobGroup("crowd", "crowd")
    for small in (1000, 12):
        got = near_report(df, small=small, depth=3)
        assert by_row(got, *got.columns) == want
        if small == 1000:
            assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("crowd")) < 80  # 57 at the time of writing
    spark.sparkContext.setJobGroup("rest", "rest")


@pytest.mark.parametrize("percent", [60, 85])
def test_links_of_a_block_join_what_full_sets_link(percent):
    rng = np.random.default_rng(percent)
    sets, base = [], rng.integers(0, 1 << 62, 40)
    for _ in range(50):
        own = base.copy()
        own[rng.integers(0, 40, rng.integers(0, 9))] = rng.integers(0, 1 << 62)
        sets.append(np.unique(np.append(own, rng.integers(0, 1 << 62, rng.integers(0, 4)))))
    component = rng.integers(0, 45, 50)
    sets_of = [set(s.tolist()) for s in sets]

    def reached(pairs):
        labels = {c: c for c in component.tolist()}
        for i, k in pairs:
            old, new = labels[component[i]], labels[component[k]]
            labels = {c: new if x == old else x for c, x in labels.items()}
        return sorted(sorted(c for c in labels if labels[c] == x) for x in set(labels.values()))

    linked = [
        (i, k)
        for i in range(50)
        for k in range(i)
        if 100 * len(sets_of[i] & sets_of[k]) >= percent * len(sets_of[i] | sets_of[k])
    ]
    left, right = links_in_block(component, sets, percent, step=7)
    assert reached(zip(left, right, strict=True)) == reached(linked)
    assert len(left) == len(set(component.tolist())) - len(reached(linked)) > 0


def test_members_joined_and_groups_kept_whole():
    labels = joined(np.arange(7), np.array([6, 2, 5]), np.array([2, 0, 4]))
    assert labels.tolist() == [0, 1, 0, 3, 4, 4, 0]
    assert joined(labels, np.array([6]), np.array([5])).tolist() == [0, 1, 0, 3, 0, 0, 0]
    keys = [1, 1, 2, 3, 3, 3, 3, 5, 6, 6]
    cuts = [0, 1, 1, 4, 6, 9, 10]
    batches = [pd.DataFrame({"key": keys[a:b], "n": range(a, b)}) for a, b in zip(cuts, cuts[1:], strict=False)]
    found = [batch["n"].tolist()[a:b] for batch, bounds in whole_groups(iter(batches), "key") for a, b in bounds]
    assert found == [[0, 1], [2], [3, 4, 5, 6], [7], [8, 9]]
    assert list(whole_groups(iter([]), "key")) == []


def test_little_is_held_for_texts_in_python(spark):
    """Batches of a few MB, and few words kept with their hashes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(4000).selectExpr("repeat(cast(id % 10 as string), 1000) AS text").coalesce(1)
    sizes = lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches)
    with small_batches(spark, 100_000):
        counts = [r["n"] for r in rows.mapInPandas(sizes, "n long").collect()]
    assert sum(counts) == 4000 and max(counts) < 400
    assert spark.conf.get(name) == before
    shingles = Shingles(5)
    for k in range(50):
        shingles.of(" ".join(f"w{x}" for x in range(1000 * k, 1000 * k + 1000)))
    assert len(shingles.words) <= 32_000
