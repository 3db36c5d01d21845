from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

from tidewell.llm import mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words, seen, inside = WORD.findall(text), {}, set()
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k : k + 3]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            inside |= {p + j for p in places for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_base_counts(spark, docs, rows):
    found = quality_rules.judge(docs).collect()
    assert len(found) == len(rows)
    expected = Counter((r[0], *base_counts(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a a", "x a b c y a b c z", "a b\na b\n\n \na b", " ".join(str(i % 40) for i in range(400))])
def test_repeats(spark, text):
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    r = quality_rules.judge(docs).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(text)


def test_far_from_every_language_is_dropped(spark):
    clean = "the cat sat on the mat and it was a day for all that is in this house by the sea "
    clean = " ".join(f"{clean}w{i}" for i in range(12))
    shouted = " ".join(w.upper() + "!!" for w in clean.split())
    docs = spark.createDataFrame([(i, clean, "en") for i in range(5)] + [(9, shouted, "en")], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect() if not r.base_failed}
    assert all(kept[i] for i in range(5) if i in kept) and not kept.get(9, False)


def test_rules_on_an_empty_table(spark, no_docs):
    assert quality_rules.judge(no_docs).count() == 0


@pytest.mark.parametrize("weights", [[1], [1, 1], [6, 3, 3, 2, 2, 8], [7, 1, 1], [5, 4, 3]])
def test_every_prefix_is_within_one_block(weights):
    placed = mixing.period(weights)
    total = sum(weights)
    assert sorted(x for s in placed for x in s) == list(range(total))
    for until in range(total + 1):
        for slots, a in zip(placed, weights, strict=True):
            assert abs(sum(x < until for x in slots) - until * a / total) < 1


def test_mixture_keeps_all_rows_and_follows_the_weights(spark, docs, rows):
    weights, other, size = {"src0": 2, "src1": 3}, 1, 2
    found = mixing.mix(docs, weights, other, size)
    assert set(docs.columns) <= {*found.columns} and found.count() == len(rows)
    got = found.select("doc_id", "stream", "block", "slot", "place").toPandas()
    assert not got.duplicated(["slot", "place"]).any()
    full = got.groupby("stream").block.max()
    until = min(got[got.stream == s].slot.max() for s in full.index)
    for stream, a in {**weights, "other": other}.items():
        for t in range(until):
            assert abs(got[(got.stream == stream) & (got.slot < t)].slot.nunique() - t * a / 6) < 1
    with duckdb.connect() as db:
        db.register("documents", docs.select("doc_id", "source").toPandas())
        want = db.execute(mixing.mix_sql(weights, other, size)).df()
    key = lambda x: Counter(map(tuple, x[["stream", "block", "slot", "place"]].astype(str).to_numpy()))
    assert key(got) == key(want)


def test_mixture_of_nothing(spark, no_docs):
    assert mixing.mix(no_docs, {"src0": 1}, 1).count() == 0


def test_buckets_do_not_change_the_order(spark, docs, monkeypatch):
    before = {(r.doc_id, r.slot, r.place) for r in mixing.mix(docs, {"src0": 2}, 1, 2).filter("doc_id < 60").collect() if r.doc_id != 5}
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 1)
    after = {(r.doc_id, r.slot, r.place) for r in mixing.mix(docs, {"src0": 2}, 1, 2).filter("doc_id < 60").collect() if r.doc_id != 5}
    assert before == after
