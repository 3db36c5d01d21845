from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tidewell.llm import components, decontaminate, simhash

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_groups(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, v in enumerate(values):
        for j in range(i):
            if (v ^ values[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_groups_are_those_of_all_pairs(spark, docs, rows):
    found = simhash.digest(simhash.near_duplicates(docs)).collect()
    assert len(found) == len(rows)
    fps = [slow_fingerprint(r[1]) for r in rows]
    groups = slow_groups(fps)
    smallest = {}
    for g, r in zip(groups, rows, strict=True):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    expected = sorted(((r[0] is None, r[0] or 0), f"{f:016x}", smallest[g]) for r, f, g in zip(rows, fps, groups, strict=True))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in found) == expected


def clustered(n_single: int, n_clusters: int, size: int) -> list[int]:
    rnd = random.Random(1)
    values = {rnd.getrandbits(64) for _ in range(n_single)}
    for _ in range(n_clusters):
        base = rnd.getrandbits(64)
        for _ in range(size):
            v = base
            for _ in range(rnd.randint(0, 5)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    return sorted(values)


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_large_clusters_over_many_blocks(spark, monkeypatch, held):
    monkeypatch.setattr(simhash, "BLOCK", 128)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    monkeypatch.setattr(simhash, "HELD_LINKS", held)
    values = clustered(300, 4, 200)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = components.components(simhash.link_edges(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4))).collect()
    root = {r.v: r.root for r in links}
    groups = slow_groups(values)
    seen = {}
    for v, g in zip(signed, groups, strict=True):
        seen.setdefault(g, set()).add(root.get(v, v))
    assert all(len(x) == 1 for x in seen.values()) and len({next(iter(x)) for x in seen.values()}) == len(seen)


def gray_sorted(values):
    def rank(v):
        for shift in (1, 2, 4, 8, 16, 32):
            v ^= v >> shift
        return v

    return np.array(sorted(values, key=rank), np.uint64)


def test_the_tree_finds_every_near_leaf_and_skips_most_nodes():
    values = gray_sorted(clustered(60_000, 20, 50))
    low, high = simhash._shared(values, simhash.LEAF)
    tree = simhash.Tree(low, high)
    query, node = tree.search(low, ~(low ^ high))
    sure = np.bitwise_count((low[:, None] ^ low[None, :]) & ~(low ^ high)[:, None] & ~(low ^ high)[None, :])
    assert np.array_equal(np.sort(query * len(low) + node), np.flatnonzero(sure <= simhash.BITS))
    assert len(tree.levels) == 4 and len(query) < 0.4 * len(low) ** 2 and tree.skipped > 0.3 * tree.visited
    masks = [own for _, own in tree.levels]
    for k in range(1, len(masks)):  # a node keeps no bit that its parent has
        assert not (masks[k] & masks[k - 1][np.arange(len(masks[k])) // simhash.FAN]).any()


def slow_kept(rows):
    """Places of the rows that stay, by all pairs; ties of one id by any row."""
    groups = slow_groups([slow_fingerprint(r[1]) for r in rows])
    best = {}
    for g, r in zip(groups, rows, strict=True):
        best[g] = min(best.get(g, (True, 0)), (r[0] is None, r[0] or 0)) if g in best else (r[0] is None, r[0] or 0)
    return sorted(best.values())


def test_dedup_keeps_the_first_row_of_each_group(spark, docs, rows, no_docs):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted((i is None, i or 0) for i in ids) == slow_kept(rows)
    assert simhash.deduplicate(no_docs).count() == 0


def test_dedup_tells_rows_apart_by_themselves(spark):
    text = [" ".join(f"{c}{i}{j}" for j in range(40)) for i, c in enumerate("abcdefgh")]
    table = [(1, text[0]), (2, text[0]), (2, text[1]), (None, text[2]), (None, text[3]), (7, text[4]), (7, text[5]), (None, text[0]), (9, text[6]), (9, text[6]), (None, text[7]), (None, text[7]), (None, None), (3, "")]
    found = simhash.deduplicate(spark.createDataFrame(table, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(1, text[0]), (2, text[1]), (None, text[2]), (None, text[3]), (7, text[4]), (7, text[5]), (9, text[6]), (None, text[7]), (3, "")]))


def test_long_path_of_links(spark):
    n = 600
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (7, 7)], "a long, b long")
    found = {r.v: r.root for r in components.components(edges).collect()}
    assert len({found[i] for i in range(n + 1)}) == 1 and found[1000] == found[1001] != found[0]
    assert components.components(edges.filter("a < 0")).count() == 0


def slow_hits(text, items):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, hit, found = ITEM_WORD.findall(low), set(), set()
    for item, item_text in items:
        own = ITEM_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in item_text or ""))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_hits_are_those_of_a_plain_search(spark, docs, rows):
    texts = {r[0]: r[1] for r in rows}
    items = [("7", " ".join(texts[3].split()[:25])), ("12", texts[4]), ("3", None), ("4", ""), ("5", "... !"), ("a,b", texts[7].upper()), ("short", " ".join(texts[9].split()[:2])), ("12", texts[4]), ("null", texts[11])]
    table = spark.createDataFrame([(None if k == "null" else k, v) for k, v in items], "item_id string, text string")
    expected = sorted((str(r[0]), *slow_hits(r[1], items)) for r in rows)
    for salts, bits in ((decontaminate.SALTS, decontaminate.FILTER_BITS), (3, 15)):
        found = decontaminate.digest(decontaminate.decontaminate(docs, table, keep=["doc_id"], salts=salts, filter_bits=bits)).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == expected


def test_empty_benchmark_and_empty_docs(spark, docs, no_docs):
    none = spark.createDataFrame([], T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))
    found = decontaminate.digest(decontaminate.decontaminate(docs, none)).collect()
    assert not any(r.contaminated for r in found) and sum(r.n_words for r in found) > 0
    assert decontaminate.decontaminate(no_docs, none).count() == 0


def test_words_of_few_texts_are_in_hand_at_once():
    """Bounded by characters: slices of the operator are a quarter of the usual ones, and lose no row."""
    import pyarrow as pa

    from tidewell.llm import textmap

    texts = pa.array(["x" * 1000] * 3000 + [None, "y" * 2_500_000, "z"])
    found = list(textmap.slices(texts, decontaminate.CHARS))
    assert [t for _, _, part in found for t in part] == texts.to_pylist()
    assert all(b - a == 1 or sum(len(t or "") for t in part) <= decontaminate.CHARS for a, b, part in found)
