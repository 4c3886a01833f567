"""The text operators on small hand-made tables: nulls, empty texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from smeltery.llm import (
    common, decontaminate, exact_dedup, jaccard_join, line_dedup, mixing, pii, shingles, token_rollup, toxicity, url_filter,
    warc,
)
from smeltery.llm.shingles import batches, shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, rule string, mark long"


def docs(spark, *texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or ""), "x", "y", 1) for i, t in enumerate(texts)], DOCS)


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota"]) + str(rng.randint(0, 30))
                    for _ in range(n))


def edited(rng, text, n):
    parts = text.split(" ")
    for _ in range(n):
        parts[rng.randrange(len(parts))] = f"edit{rng.randint(0, 10**6)}"
    return " ".join(parts)


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    while True:
        before = list(label)
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            return [(i, len(s), label[i]) for i, s in enumerate(sets)]


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(3)
    bases = [words(rng, n) for n in (6, 20, 66, 130, 300)]
    texts = [edited(rng, b, rng.randint(0, max(1, len(b.split()) // 25))) for b in bases for _ in range(14)]
    crowd = words(rng, 90)
    texts += [edited(rng, crowd, rng.randint(0, 5)) for _ in range(40)]
    return texts + [None, "", "  \t\n", "one two", "ONE  two", texts[3], texts[3].upper(), "é " * 30, words(rng, 6000)]


def test_jaccard_components_equal_brute_force(spark, near_texts):
    got = jaccard_join.jaccard_components(docs(spark, *near_texts)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(near_texts)


def test_jaccard_of_nothing_and_repeated_rows(spark):
    assert jaccard_join.jaccard_components(docs(spark).limit(0)).count() == 0
    twice = docs(spark, "a b c d e f g").union(docs(spark, "a b c d e f g"))
    assert [r[2] for r in jaccard_join.jaccard_components(twice).collect()] == [0, 0]
    assert jaccard_join.one_of_each(docs(spark, "a b c d e f", "A b c d e f", None)).count() == 2


def test_similar_sets_share_a_signature():
    rng, none = np.random.default_rng(1), np.zeros(0, np.uint64)
    for size in (5, 63, 64, 70, 127, 128, 129, 500, 2000):
        a = np.sort(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for other in (size, int(size * 1.1), size * 4 // 3):
            keep = -(-3 * (size + other) // 7)
            if keep > size:
                continue
            b = np.sort(np.concatenate([rng.permutation(a)[:keep], rng.integers(0, 1 << 63, other - keep).astype(np.uint64)]))
            assert np.intersect1d(jaccard_join.signatures(a, none, none), jaccard_join.signatures(b, none, none)).size


def test_pooled_crowds_keep_every_pair_of_a_signature(spark):
    rows = [(m, r, 5, r, 0, 1, 7) for m in (1, 2, 3) for r in range(20, 26)]
    rows += [(m, r, 5, r, 0, 1, 8) for m, own in ((4, (30, 31)), (5, (32, 33)), (6, (34, 35))) for r in own]
    rows += [(9, 40, 5, 40, None, None, None), (9, 41, 5, 41, None, None, None)]
    held = spark.createDataFrame(rows, "mark long, rep long, n long, label long, alone long, apart long, centre long")
    got = jaccard_join.pooled(held).select("by_centre", "key", "rep").collect()
    groups = {}
    for by_centre, key, rep in got:
        groups.setdefault((by_centre, key), []).append(rep)
    assert {k: sorted(v) for k, v in groups.items()} == {
        (True, 7): list(range(20, 26)), (False, 4): [30, 31], (False, 5): [32, 33], (False, 6): [34, 35], (False, 9): [40, 41]}


def test_components_of_a_crowd_and_of_slices(spark, monkeypatch):
    rng = random.Random(5)
    base = words(rng, 300)
    crowd = [edited(rng, base, k) for k in (4, 9, 14, 20, 25) for _ in range(14)]
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs(spark, *crowd)).collect())) == brute_components(crowd)
    texts = [(i, t) for i, t in enumerate(crowd)] + [(None, crowd[0]), (99, None)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in texts], pa.int64()), "text": [t for _, t in texts]})
    once = pa.Table.from_batches(jaccard_join._describe([batch]))
    monkeypatch.setattr(jaccard_join, "SLICE", 1000)
    monkeypatch.setattr(shingles, "BATCH_BYTES", 3000)
    sliced = pa.Table.from_batches(jaccard_join._describe([batch]))
    facts = lambda t: t.filter(pc.is_valid(t["n"])).select(["doc_id", "n", "digest", "sketch"]).to_pylist()
    assert facts(once) == facts(sliced) and len(facts(once)) == len(texts)
    none = np.zeros(0, np.uint64)
    pairs = lambda out: {(m, o) for b in out for r in b.to_pylist()
                         for m, o in zip(np.frombuffer(r["marks"], np.uint64).tolist(), np.frombuffer(r["ids"], np.int64).tolist(), strict=True)}
    known = batch.slice(0, len(crowd))
    assert pairs(jaccard_join._emit(64, none, none.view(np.int64))([known])) == {
        (m, i) for i, s in enumerate(shingle_sets([t.encode() for t in crowd])) for m in jaccard_join.signatures(s, none, none.view(np.int64)).tolist()}


def test_features_of_their_own_are_counted_from_blocks(spark, monkeypatch):
    rng = random.Random(8)
    common = words(rng, 40)
    texts = [f"{common} {words(rng, k)}" for k in (0, 5, 30, 60)] + [f"{common} {words(rng, 9)}"] * 2
    frame = spark.createDataFrame([*enumerate(texts), (3, texts[3])], "id long, text string")
    sets = [set(x.tolist()) for x in shingle_sets([t.encode() for t in texts])]
    want = {i: len(s.difference(*(t for j, t in enumerate(sets) if j != i))) for i, s in enumerate(sets)}
    assert {r.rep: r.alone for r in jaccard_join._alone(frame, 8).collect()} == want
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    once = pa.Table.from_batches(jaccard_join._own_features(8)([batch])).num_rows
    assert once <= 8 < sum(map(len, sets))  # a row a bucket, not one a feature
    monkeypatch.setattr(jaccard_join, "SLICE", 50)
    assert {r.rep: r.alone for r in jaccard_join._alone(frame, 8).collect()} == want


def test_sketches_rule_out_unlike_sets_of_any_size_only():
    rng = np.random.default_rng(4)
    for n in (1, 40, 700, 9000):
        one = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        for share, stays in ((0.95, True), (0.4, False)):
            for m in (len(one), len(one) * 5 // 4):
                same = one[:max(1, int(share * n))]
                other = np.unique(np.append(same, rng.integers(0, 2 ** 63, m - len(same)).astype(np.uint64)))
                both = len(np.intersect1d(one, other))
                rows = pd.DataFrame({"a": [1], "b": [2], "n": [len(one)], "m": [len(other)], "x": [jaccard_join.sketch(one)], "y": [jaccard_join.sketch(other)]})
                got = sum(map(len, jaccard_join._may_link(iter([rows]))))
                similar = 4 * both >= 3 * (len(one) + len(other) - both)
                assert got == 1 if similar else stays or n < 100 or got == 0  # an average of byte counts could not tell 9,000 apart


def test_crowds_of_unlike_holders_are_sifted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIDE", 7)
    monkeypatch.setattr(jaccard_join, "WIDE", 64)
    rng = random.Random(6)
    texts = [words(rng, rng.choice((200, 230, 260))) for _ in range(30)]
    texts += [edited(rng, texts[4], 2), edited(rng, texts[9], 3), edited(rng, texts[17], 2)]
    sets = shingle_sets([t.encode() for t in texts])
    label = lambda i: 9 if i == 31 else i  # noqa: E731  31 is in the component of 9 already
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    crowd = frame([(m, i, len(s)) for m in (5, 6) for i, s in enumerate(sets) if i or m == 5], "mark long, rep long, n long")
    whole = frame([(i, i, len(s), label(i)) for i, s in enumerate(sets)], "doc_id long, rep long, n long, label long")
    sketches = frame([(i, len(s), jaccard_join.sketch(s)) for i, s in enumerate(sets)], "rep long, n long, sketch binary")
    got = jaccard_join.sifted(crowd, whole, sketches).collect()
    assert sorted((r.mark, r.rep) for r in got) == [(m, i) for m in (5, 6) for i in (4, 17, 30, 32)]


def test_marked_rows_hold_every_wanted_key_and_null(spark):
    rows = spark.createDataFrame([(i, "t") for i in range(3000)] + [(None, "t")], "id long, text string")
    wanted = spark.createDataFrame([(i,) for i in range(0, 3000, 7)], "k long")
    got = common.marked(rows, rows["id"], wanted, "may").collect()
    assert len(got) == 3001 and {r.id for r in got if r.may} == set(range(0, 3000, 7))
    null = common.marked(rows, rows["id"], spark.createDataFrame([(None,)], "k long"), "may")
    assert [r.id for r in null.where("may").collect()] == [None]
    assert common.marked(rows, rows["id"], wanted.limit(0), "may").where("may").isEmpty()


def test_only_rows_that_may_go_are_moved(spark, monkeypatch):
    texts = [f"text {i}" for i in range(40)] + ["Text 3", "TEXT 7"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup.drop_exact_duplicates(docs(spark, *texts))
        assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(42) if i not in (3, 7)]
        near = jaccard_join.one_of_each(docs(spark, *texts))
        assert sorted(r.doc_id for r in near.collect()) == list(range(40))
        for plan in (kept, near):
            assert "Union" in plan._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_go_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, then in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (50, 50)):
            spark.conf.set(name, str(given))
            common.small_batches(spark.range(1))
            assert spark.conf.get(name) == str(then)
        spark.conf.set(name, "10000")
        toxicity.drop_toxic(docs(spark, "a"), spark.createDataFrame([], "doc_id long, toxic int"))
        assert spark.conf.get(name) == str(common.BATCH_ROWS)
    finally:
        spark.conf.set(name, before)


def test_shingles_hash_whole_words():
    a, b, c, d = shingle_sets([b"A b\tc d e f", b"a B c\nd e f", b"a b c d ef", b""])
    assert (a == b).all() and len(a) == 2 and len(c) == 1 and len(d) == 0


def test_short_texts_alone_in_a_batch(spark):
    for text in (b"", b"one", b"one two", b"one two three", b"a b c d"):
        alone, among = shingle_sets([text])[0], shingle_sets([b"a long text of many words", text])[1]
        assert alone.tolist() == among.tolist() and len(alone) == bool(text)
    long = "word " * 450_000
    runs = [shingle_sets(run) for _, run in batches([long, "one two", long, "one two three"])]
    assert [len(x) for run in runs for x in run] == [1, 1, 1, 1] and len(runs) == 4
    assert [tuple(r)[:3] for r in jaccard_join.jaccard_components(docs(spark, "one two")).collect()] == [(0, 1, 0)]


def test_exact_duplicates(spark):
    got = exact_dedup.exact_duplicates(docs(spark, "Abc", "aBC", None, "", "É", "é", "x" * 9000))
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got.collect()}
    assert rows == {0: (1, 2, False), 1: (1, 2, True), 2: (3, 2, False), 3: (3, 2, True),
                    4: (4, 1, True), 5: (5, 1, True), 6: (6, 1, True)}
    assert exact_dedup.exact_duplicates(docs(spark).limit(0)).count() == 0
    kept = exact_dedup.drop_exact_duplicates(docs(spark, "Abc", "aBC", None))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == docs(spark).columns


def test_chunks_are_the_text(spark):
    text = ("word, " * 900 + "\n" + "y" * 10000)
    assert "".join(docs(spark, text).select(exact_dedup.chunks(common.whole_text("text"))).first()[0]) == text


def test_url_rules(spark):
    pages = spark.createDataFrame([(0, "http://A.Example.org/es/x?q#f"), (1, "x://org"), (2, "http://org/"), (3, None), (4, "nothing"),
                                   (5, "http://forg/"), (6, "http://b.com/de/"), (7, "http://b.com/de/")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")],
                                  "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[1] == ("org", "", None, "allow")
    assert got[2][2:] == ("org/", "allow") and got[3] == got[4] == ("", "", None, "allow") and got[5][2] is None
    assert got[6] == got[7] == ("b.com", "/de/", "com/de/", "block")
    assert url_filter.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 8
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_targets_stop_at_their_limit():
    got = mixing.targets({"a": 100, "b": 900, "c": 0}, {"a": 1, "b": 2, "c": 3})
    assert got["c"] == 0 and got["a"] == 300 and got["b"] == 700


def test_flow_repeats_only_where_it_must():
    flow = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 12, "b": 10})
    assert sum(flow[("a",)].values()) + sum(flow[("a", "b")].values()) == 22
    assert sum(f.get("b", 0) for f in flow.values()) == 10
    assert max(sum(f.values()) for f in flow.values()) <= 12


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(1, 40)) if i % 9 else None, ["a", "b", None][i % 3]) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_by_source(table).toPandas()
    assert len(got) == 300 and (got.taken <= 3 * got["size"]).all() and (got.taken[got["size"] == 0] == 0).all()
    for (_, target), taken in got.groupby(["source_size", "target"]).taken.sum().items():
        assert abs(taken - target) <= 3
    again = mixing.mix_by_source(table.repartition(7)).toPandas()
    assert sorted(map(tuple, got[["doc_id", "taken"]].values)) == sorted(map(tuple, again[["doc_id", "taken"]].values))
    assert mixing.mix_by_source(table.limit(0)).count() == 0


def test_warc_round_trip(spark):
    html = ["same", "same", None, "", "WARC/1.1 \x1f", "ü" * 5000, "same"]
    pages = spark.createDataFrame([(i, f"http://h/{i}\n", h) for i, h in enumerate(html)] + [(None, None, "same")],
                                  "page_id long, url string, html string")
    for split in (50, 1 << 20):
        got = {r.page_id: tuple(r)[1:] for r in warc.pages_through_warc(spark, pages, split).collect()}
        assert len(got) == 8
        for i, h in enumerate(html):
            assert got[i][:2] == (len((h or "").encode()), warc.digest32((h or "").encode()))
        assert [got[i][2:] for i in (0, 1, 6, 2, 3)] == [("response", None), ("revisit", 0), ("revisit", 0),
                                                        ("response", None), ("revisit", 2)]
        assert got[None][2:] == ("revisit", 0)
    assert warc.pages_through_warc(spark, pages.limit(0)).count() == 0


def test_warc_headers_of_any_length(spark, folder):
    url = "data:" + random.Random(8).randbytes(1 << 20).hex()
    pages = spark.createDataFrame([(0, "http://h/0", "a"), (1, url, "b"), (2, url[:150_000], "b"), (3, "http://h/3", "c")],
                                  "page_id long, url string, html string").coalesce(1)
    assert sorted(r.page_id for r in warc.pages_through_warc(spark, pages, 50_000).collect()) == [0, 1, 2, 3]
    manifest = warc.write_warc(warc.with_revisits(pages), folder)
    read = warc.read_warc(manifest)
    assert {r.target_uri for r in read.collect()} >= {url, url[:150_000]}
    with pytest.raises(ValueError, match="records read differ"):
        warc.checked(read, manifest.withColumn("records", F.col("records") + 1))


def test_base_spans():
    text = "a@b.c@d.e x.y@h-1.co, 1.2.3.4.5 999.1.1.1, 4111 1111 1111 1111 +1 (743) 555-3824."
    assert [text[a:b] for _, a, b in pii.base_spans(text)] == ["a@b.c", "x.y@h-1.co", "1.2.3.4", "4111 1111 1111 1111",
                                                               "+1 (743) 555-3824"]
    assert pii.base_spans("1.1.1 4111 1111 1111 1111") == []  # the leftmost match starts earlier and fails: no retry
    assert pii.base_spans("9" * 200_000) == pii.base_spans("") == []


def test_tagger_finds_forms_the_patterns_miss():
    rng = np.random.default_rng(0)
    kinds = {"email": lambda: f"user{rng.integers(99)}.x@mail{rng.integers(9)}.example.org", "phone": lambda: "+1 (743) 555-38%02d" % rng.integers(99),
             "card": lambda: "4111111111111111", "ip": lambda: ".".join(str(n) for n in rng.integers(10, 255, 4))}

    def sample():
        kind = str(rng.choice(list(kinds)))
        piece = kinds[kind]()
        head = "the words of this line "[: int(rng.integers(5, 22))]
        return head + piece + " and so on", [(kind, len(head), len(head) + len(piece))]

    train = [p for p in (sample() for _ in range(250)) for p in (p, pii.missed_form(*p, rng))]
    tagger = pii.Tagger(0)
    assert tagger.train(*pii.encode(train), steps=200) < 5
    held = [pii.missed_form(*sample(), rng) for _ in range(60)]
    found = tagger.tag([t for t, _ in held])
    good = sum(any(k == s[0][0] and a < s[0][2] and s[0][1] < b for k, a, b in f) for f, (_, s) in zip(found, held, strict=True))
    assert good >= 45
    assert tagger.tag(["no digits here at all", ""]) == [[], []]


def test_pii_query_keeps_all_rows(spark):
    got = {r.doc_id: r for r in pii.find(docs(spark, "mail a@b.co", None, "", "1.2.3.4"), None).collect()}
    assert len(got) == 4 and got[0].spans == "email:5:11" and got[1].spans == "" and got[3].n_ip == 1
    assert pii.fit(docs(spark, None, "")) is None


def test_toxicity(spark):
    rng = random.Random(2)
    texts = [words(rng, 30) + (" You IDIOT, scum" if i % 4 == 0 else "") for i in range(240)] + [None, ""]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs(spark, *texts), labels)
    got = toxicity.score_texts(docs(spark, *texts), index).toPandas()
    assert len(got) == 242 and (got.predicted[:240] == [int(i % 4 == 0) for i in range(240)]).all() and not got.predicted[240:].any()
    assert got.score.between(0, 1).all() and got.held_out.any() and not got.held_out.all()
    assert toxicity.drop_toxic(docs(spark, *texts), labels).count() == 182
    assert toxicity.fit(docs(spark, *texts), labels.limit(0)) is None


def test_toxicity_uses_weak_terms(spark):
    rng = random.Random(6)
    rude = ["oaf", "twit", "dolt", "lout", "boor", "yob", "git", "prat"]
    toxic = {i: " you IDIOT" if i % 8 == 0 else f" you {rude[i // 8 % 8]}" for i in range(0, 480, 4)}
    texts = [words(rng, 30) + toxic.get(i, "") for i in range(480)]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(480)], "doc_id long, toxic int")
    index = toxicity.fit(docs(spark, *texts), labels)
    assert {*rude, "idiot", "alpha"} <= index.place.keys() and (index.idf > 0).all()
    got = toxicity.score_texts(docs(spark, *texts), index).where("held_out").toPandas().set_index("doc_id").score
    weak = [i for i in got.index if i % 8 == 4]
    clean = [i for i in got.index if i % 4]
    assert len(weak) > 9 and got[weak].mean() > got[clean].mean() + 0.3


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    terms = [f"t{i}" for i in range(40)]
    examples = [(i, i % 2, {t: int(rng.integers(1, 4)) for t in rng.choice(terms, 5, replace=False)}) for i in range(500)]
    index = toxicity.Index.build(terms, rng.uniform(1, 5, 40), examples)
    for i, _, counts in examples[:50]:
        at, weight = index.vector(counts)
        every = np.einsum("t,tbk->bk", weight, index.tiles[at]).ravel()
        assert np.allclose(index.nearest(at, weight, 15)[1], np.sort(every)[::-1][:15])


def test_decontamination_sees_other_parameters(spark):
    item = "then Anna buys 12 kg of fresh red apples and gives 3 kg of them to her brother Paul before Anna leaves"
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    moved = item.replace("12", "40").replace("Anna", "Ruth").replace("Paul", "Igor")
    broken = item.replace("Anna", "Ruth", 1)
    got = {r.doc_id: r for r in decontaminate.judged(
        docs(spark, f"x y z. {item} more", moved, f"so, {item.upper()} so", broken.replace("3 kg", "12 kg"), "clean text", None, ""), bench).collect()}
    assert [got[i].contaminated for i in (0, 1, 4, 5, 6)] == [True, True, False, False, False]
    assert got[0].items == "7" and not got[0].changed and got[1].changed and got[2].contaminated
    assert decontaminate.judged(docs(spark, "a"), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.drop_contaminated(docs(spark, item, "fine"), bench).count() == 1


def test_decontamination_in_any_case(spark):
    item = "Anna and Paul met in Rome. Then Ruth told Igor that Berta had left Oslo for Bonn on Monday"
    bench = spark.createDataFrame([(7, item), (8, "Did Anna ever ask whether Paul could come along")], "item_id long, text string")
    texts = [f"so {t} so" for i in (item, bench.collect()[1].text) for t in (i, i.lower(), i.upper(), i.title())]
    got = {r.doc_id: r for r in decontaminate.judged(docs(spark, *texts, "Did Eve ever ask whether Igor could come along"), bench).collect()}
    assert [got[i].items for i in range(9)] == ["7"] * 4 + ["8"] * 5
    assert [got[i].changed for i in range(9)] == [False] * 8 + [True]


def test_decontamination_counts_equal_windows_always(spark):
    item = "then Anna buys 12 kg of fresh red apples and gives 3 kg of them to her brother Paul before Anna leaves"
    sums, short = "Add 12 and 15, 17 and 18, 21 and 29, 31 and 32, 41", "How old is Berta now?"
    bench = spark.createDataFrame([(1, item), (2, sums), (3, short), (4, "Paul Anna Igor Ruth Eve Berta Otto Ida Max Ute")],
                                  "item_id long, text string")
    texts = [item.replace("before Anna", "before Ruth"), item.replace("12", "3"), f"x {sums} y", f"We asked: {short} Nobody knew it at all that day.",
             "So Paul Anna Igor Ruth Eve Berta Otto Ida Max Ute went", "We asked: how old is Bertana now? Nobody knew it.",
             "So Hans Lena Fritz Kurt Olga Nina Sven Lars Finn Jan went"]
    got = {r.doc_id: r.items for r in decontaminate.judged(docs(spark, *texts), bench).collect()}
    assert [got[i] for i in range(7)] == ["1", "1", "2", "3", "4", "", ""]


def test_near_lines(spark):
    line = "this is a line of some length that will be seen again"
    moved = "X" + line[:20] + line[21:]
    got = {r.doc_id: (r.n_lines, r.n_kept, r.text) for r in line_dedup.deduplicated(
        docs(spark, f"{line}\nshort\n\nshorx", f"{moved}\nshort", None, "", line.upper(), line + " abc")).collect()}
    assert got == {0: (4, 4, f"{line}\nshort\n\nshorx"), 1: (2, 0, ""), 2: (1, 1, ""), 3: (1, 1, ""), 4: (1, 0, ""),
                   5: (1, 1, line + " abc")}
    assert line_dedup.deduplicated(docs(spark).limit(0)).count() == 0


def test_near_lines_equal_brute_force(spark):
    rng = random.Random(9)
    texts = set()
    for n in (30, 31, 32, 47, 80):
        base = "".join(rng.choice("abcde ") for _ in range(n - 2)) + "xx"
        for _ in range(25):
            t = list("q" + base)
            for _ in range(rng.randint(0, 3)):
                p = rng.randrange(1, len(t) - 1)
                t[p:p + rng.randint(0, 1)] = rng.choice(["", "z", "y"])
            texts.add("".join(t))
    rows = [(i, t, len(t)) for i, t in enumerate(sorted(texts)) if len(t) >= 30]
    table = spark.createDataFrame(rows, "line_id long, line string, n int")
    want = spark.createDataFrame(rows, "a long, al string, an int").crossJoin(spark.createDataFrame(rows, "b long, bl string, bn int"))
    want = want.where("levenshtein(al, bl) <= 2 AND a <> b AND (bn > an OR bn = an AND a < b)").select("a", "b")
    assert sorted(map(tuple, line_dedup.near_lines(table).collect())) == sorted(map(tuple, want.collect()))


def test_lines_move_without_their_text_once_placed(spark, monkeypatch):
    line = "a line that is long enough to be compared, and comes twice"
    rows = [(1, f"{line}\n\nonce"), (1, f"Once\n{line}"), (1, f"{line}\n\nonce"), (None, line), (None, "x\tY"), (2, None),
            (3, f"x y\n{line}!\nÉ x\n\n{line}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    lines, labels = line_dedup.line_classes(frame), []
    kept = F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("at", "raw"))))
    want = lines.groupBy("doc_id").agg(F.count("*"), F.count_if("kept"), kept.alias("k")).collect()
    put = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: labels.append((label, df.columns)) or put(df, label))
    got = line_dedup.deduplicated(frame)
    assert {tuple(r) for r in got.collect()} == {(i, n, k, "\n".join(z.raw for z in x)) for i, n, k, x in want}
    moved = dict(labels)
    assert moved["line-gone"] == ["doc_id", "of", "at"] and not {"raw", "line", "text"} & {*moved["line-digests"]}


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_band_equals_edit_distance(spark, edits):
    rng = random.Random(11 + edits)
    rows = [("", ""), ("", "ab"), ("abc", ""), ("\u00e9\U0001f600x", "\U0001f600x"), ("a" * 300, "a" * 302), (None, "a")]
    for _ in range(400):
        a = "".join(rng.choice("abc\u00e9\U0001f600") for _ in range(rng.randrange(0, 14)))
        b = list(a)
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(0, len(b) + 1)
            b[at:at + rng.randrange(0, 2)] = rng.choice(["", "a", "b", "\u00e9"])
        rows.append((a, "".join(b)))
    table = spark.createDataFrame(rows, "a string, b string")
    wrong = table.where(line_dedup.within_edits(F.col("a"), F.col("b"), edits)
                        != F.coalesce(F.levenshtein("a", "b") <= edits, F.lit(False)))
    assert wrong.count() == 0


def test_rollup_is_additive_and_idempotent(spark, folder):
    rollup = token_rollup.TokenRollup(spark, folder)
    shape = "doc_id long, tokenizer string, op string, source string, lang string, tokens long, text string"
    rows = lambda *r: spark.createDataFrame([(*x, "extra") for x in r], shape)
    assert rollup.apply("b1", rows((1, "t", "insert", "a", "en", 5), (2, "t", "insert", None, "en", None), (None, "t", "insert", "a", "en", 9)))
    assert not rollup.apply("b1", rows((1, "t", "insert", "a", "en", 5)))
    assert rollup.apply("b2", rows((1, "t", "revise", "b", "en", 7), (3, "t", "delete", "a", "en", 1)))
    assert rollup.apply("b3", rows((2, "t", "delete", None, "en", 0))) and rollup.apply("b4", rows().limit(0))
    assert [tuple(r) for r in rollup.totals().collect()] == [("b", "en", "t", 1, 7)]
    spark.createDataFrame([("x", "en", "t", 9, 9)], token_rollup.TOTALS).write.parquet(f"{folder}/totals/batch=broken")
    assert rollup.totals().count() == 1


def test_toxicity_examples_are_opened_one_at_a_time():
    words = [[f"w{i}x{j}" for j in range(300)] for i in range(200)]
    table = pa.table({"doc_id": [*range(199, -1, -1)], "toxic": pa.array([i % 2 for i in range(200)], pa.int32()),
                      "terms": [" ".join(w) for w in words[:199]] + [""],
                      "times": [np.full(300, 2 + i, np.int64).tobytes() for i in range(199)] + [b""]})
    examples = toxicity.Examples(table)
    tracemalloc.start()
    seen = sum(sum(c.values()) for _, _, c in examples)
    peak = tracemalloc.get_traced_memory()[1]
    held = [*examples]
    assert peak < tracemalloc.get_traced_memory()[0] / 20
    tracemalloc.stop()
    assert seen == sum(300 * (2 + i) for i in range(199))
    assert held[0] == (0, 1, {}) and held[1][:2] == (1, 0) and held[1][2] == dict.fromkeys(words[198], 200)
    assert [i for i, _, _ in held] == [*range(200)]


def test_letters_are_counted_only_of_lines_that_share_a_mark(spark, monkeypatch):
    rng = random.Random(4)
    line = "a line that is long enough to be compared with others, é"
    texts = [line, line[:10] + line[11:], line.replace("long", "lung"), *("".join(rng.choice("abcdefgh ") for _ in range(50)) + "x" for _ in range(60))]
    table = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "line_id long, line string, n int")
    counted, tallied = [], line_dedup.tallied
    monkeypatch.setattr(line_dedup, "tallied", lambda lines: counted.extend(r.line_id for r in lines.collect()) or tallied(lines))
    got = sorted(map(tuple, line_dedup.near_lines(table).collect()))
    assert got == [(0, 2), (1, 0), (1, 2)] and sorted(counted) == [0, 1, 2]
