import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from trovespark.operators import attribute, dense, distil, evaluate, evidence, fusion, generate, ranking, rerank, windows
from trovespark.plans import config, route
from trovespark.sources import readers, sinks
from trovespark.streaming import claims


def run(spark, rows):
    return spark.createDataFrame(rows, "qid string, docno string, rank int, score double")


def lists(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append(r.docno)
    return out


def test_fusion_by_hand(spark):
    a = run(spark, [("q", "x", 1, 2.0), ("q", "y", 2, 1.0), ("r", "z", 1, 1.0)])
    b = run(spark, [("q", "y", 1, 9.0), ("q", "x", 2, 1.0), ("s", "w", 1, 1.0)])
    assert lists(fusion.two_legs(a, b, 10, 10)) == {"q": ["x", "y"], "r": ["z"], "s": ["w"]}
    assert lists(fusion.after_rerank(a, b, 10, 10)) == {"q": ["x", "y"], "r": ["z"]}
    scores = {(r.qid, r.docno): r.score for r in fusion.fuse([a, b], first_weight=0.75).collect()}
    assert scores["r", "z"] == pytest.approx(1 / 61) and scores["s", "w"] == pytest.approx(1 / 61) and scores["q", "x"] == pytest.approx(0.75 / 61 + 0.25 / 62)
    assert lists(fusion.fuse([a, b], [1.0, 0.0])) == {"q": ["x", "y"], "r": ["z"]}
    repeated = run(spark, [("q", "x", 1, 1.0), ("q", "y", 2, 1.0), ("q", "x", 3, 1.0)])
    assert [(r.docno, r.rank) for r in fusion.positioned(repeated).orderBy("rank").collect()] == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        fusion.weight_list("1,2", 3)
    assert fusion.weight_pairs("1,1;2,1") == [(1, 1), (2, 1)]


def test_parents(spark):
    chunks = run(spark, [("q", d, i, None) for i, d in enumerate(["a#1", "b#1", "a#2", "c#1", "b#2"], 1)])
    assert lists(ranking.top_parents(chunks, 2, 1)) == {"q": ["a#1", "b#1"]}
    assert lists(ranking.top_parents(chunks, 2, 2)) == {"q": ["a#1", "b#1", "a#2", "b#2"]}
    assert lists(ranking.cap_chunks(chunks, 1)) == {"q": ["a#1", "b#1", "c#1"]} and lists(ranking.first_chunk(chunks)) == {"q": ["a", "b", "c"]}
    best = ranking.best_chunk(run(spark, [("q", "a#1", 1, 1.0), ("q", "b", 2, 3.0)])).orderBy("rank").collect()
    assert [(r.docno, r.rank) for r in best] == [("b", 0), ("a", 1)]


def test_cutoff_rules(spark):
    fused = run(spark, [("q", d, i, None) for i, d in enumerate("abcde", 1)])
    scores = run(spark, [("q", "a", 0, 0.1), ("q", "b", 0, 0.9), ("q", "c", 0, float("nan")), ("q", "d", 0, 0.8)])
    clean = rerank.best_scores(scores)
    assert lists(rerank.cutoff(fused, clean, 0.5, 0)) == {"q": ["b", "d"]}
    assert lists(rerank.cutoff(fused, clean, 0.5, 3)) == {"q": ["b", "d", "a"]}
    assert lists(rerank.cutoff(fused, clean, 0.5, 3, 1)) == {"q": ["b", "a", "c"]}


def test_rerank_keeps_order_of_ties_and_misses(spark):
    first = run(spark, [("q", "a", 1, 1.0), ("q", "b", 2, 1.0), ("q", "c", 3, 1.0), ("e", "a", 1, 1.0)])
    topics = spark.createDataFrame([("q", "big cat"), ("e", " ")], "qid string, query string")
    texts = spark.createDataFrame([("a", "dog"), ("c", "a big cat")], "docno string, text string")
    assert lists(rerank.rerank(first, topics, texts)) == {"q": ["c", "a", "b"]}
    assert lists(rerank.rerank(first, topics, texts, skip_empty=False))["e"] == ["a"]
    snippets = first.select("qid", "docno").join(texts, "docno")
    requests = rerank.listwise_requests(first, topics, snippets, 5)
    assert lists(rerank.permuted(requests)) == {"e": ["a"], "q": ["c", "a"]}

    def load():
        return lambda queries, docs: [float(len(d)) for d in docs]

    assert lists(rerank.rerank(first, topics, texts, rerank.arrow_scorer(load)))["q"] == ["c", "a", "b"]


def test_windows(spark):
    docs = spark.createDataFrame([("q", "d", "T", list("abcde")), ("q", "e", "T", ["a"]), ("q", "f", "T", []), ("q", "g", "", [])], "qid string, docno string, title string, sentences array<string>")
    got = {}
    for r in windows.build(docs, 3, 2).orderBy("docno", "window_idx").collect():
        got.setdefault(r.docno, []).append((r.sent_start, r.window_text))
    assert got == {"d": [(0, "T a b c"), (2, "T c d e")], "e": [(0, "T a")], "f": [(0, "T")]}
    rows = spark.createDataFrame([("q", "d", 0, 0, "", 0.9, "f"), ("q", "d", 2, 2, "", 0.8, "f"), ("q", "d", 5, 5, "", 0.7, "f")], readers.WINDOW)
    chosen = {r.window_idx: (r.chosen, r.overlap) for r in windows.choose(rows).collect()}
    assert chosen == {0: (True, 0), 2: (False, 1)}
    assert windows.source_label(windows.embedded(windows.choose(rows))).first().source == "embedded"


def test_clusters_by_brute_force():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(size=(4, 8)) * 0.05 + c for c in np.eye(8)[:3]])
    assert distil.cluster(points, 0.4).tolist() == [0] * 4 + [1] * 4 + [2] * 4
    assert distil.cluster(points[:1], 0.4).tolist() == [0] and distil.cluster(points, 0.0).tolist() == list(range(12)) and set(distil.cluster(points, 3.0)) == {0}


def test_packing_turns_and_budget(spark):
    cache = spark.createDataFrame([("q", "c1", "d1", 0, 0.5, ["a b c", "d e f"]), ("q", "c2", "d2", 1, 0.9, ["A b, c", "g h i"]), ("q", "c3", "d3", 2, float("nan"), ["j k l"]), ("q", "c4", "d4", 40, 1.0, ["x y z"])], "qid string, context_id string, doc_id string, rank int, ce_score double, claims array<string>")
    found = distil.claims(cache)
    assert [(r.context_id, r.text) for r in distil.packed(found, slots=9).orderBy("place").collect()] == [("c2", "A b, c"), ("c1", "d e f"), ("c3", "j k l"), ("c2", "g h i")]
    assert distil.packed(found, budget=4).count() == 2 and distil.packed(found, slots=1).count() == 1


def test_attribution(spark):
    slots = spark.createDataFrame([("q", "s1", "d1", "red apples grow quickly", None, None), ("q", "s2", "d2", "blue whales swim far", ["m1", "m2"], ["d2", "d3"])], "qid string, id string, doc_id string, text string, member_ids array<string>, member_doc_ids array<string>")
    evid = spark.createDataFrame([("q", 1, "s2"), ("q", 2, "s1"), ("q", 3, "gone")], "qid string, pos int, id string")
    sents = spark.createDataFrame([("q", 0, "Red apples grow."), ("q", 1, "Nothing alike."), ("q", 2, "Whales swim far and apples grow quickly red.")], "qid string, sent int, text string")
    cites = lambda df: {s: [r.doc_id for r in sorted(df.where(f"sent = {s}").collect(), key=lambda r: r.cite)] for s in range(3)}
    assert cites(attribute.trivial(sents, evid, slots)) == {s: ["d2", "d3", "d1"] for s in range(3)}
    assert [r.id for r in attribute.unresolved(evid, slots).collect()] == ["gone"]
    assert cites(attribute.lineage(sents, evid, slots)) == {0: ["d1"], 1: ["d2"], 2: ["d1", "d2"]}
    members = spark.createDataFrame([("q", "m2", ["whales swim far"])], "qid string, context_id string, claims array<string>")
    assert cites(attribute.descent(sents, evid, slots, members)) == {0: ["d1"], 1: ["d2"], 2: ["d1", "d3", "d2"]}
    (row,) = attribute.attributed(sents, attribute.lineage(sents, evid, slots)).collect()
    assert [s.doc_ids for s in row.answer_sentences] == [["d1"], ["d2"], ["d1", "d2"]]
    modes = spark.createDataFrame([("claim",)], "m string").select(attribute.route(F.col("m")).alias("r"))
    assert modes.first().r == "lineage"
    with pytest.raises(Exception, match="without claim"):
        spark.createDataFrame([("document",)], "m string").select(attribute.route(F.col("m"))).collect()


def test_metrics_by_hand(spark):
    gold = spark.createDataFrame([("q", f"g{i}") for i in range(20)] + [("z", "g1")], "qid string, docno string")
    full = run(spark, [("q", f"g{i}#1", i + 1, None) for i in range(10)])
    universe = spark.createDataFrame([("q",), ("z",), ("none",)], "qid string")
    got = {r.qid: r for r in evaluate.per_query(full, gold, universe).collect()}
    assert got["q"].ap == pytest.approx(1.0) and got["q"].recall == 0.5 and got["z"].ap == 0 and got["none"].rr == 0
    assert evaluate.per_query(full, gold, universe, collapse=False).where("qid = 'q'").first().ap == 0
    assert {r.qid for r in evaluate.per_query(full, gold, universe, scope="nonempty").collect()} == {"q"}
    assert [r.qid for r in evaluate.zero_recall(full, gold, 10).collect()] == ["z"]


def test_dense_shards(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0], 0), ("a", [0.0, 1.0], 1), ("b", [0.6, 0.8], 1), (" ", [1.0, 0.0], 0), ("c", None, 0)], "docno string, vector array<double>, shard int")
    queries = spark.createDataFrame([("q", [0.0, 1.0])], "qid string, vector array<double>")
    assert lists(dense.retrieve_sharded(rows, queries, 5)) == {"q": ["a", "b"]}
    assert lists(dense.retrieve_sharded(rows, queries, 5, first_shard=True)) == {"q": ["b", "a"]}
    assert dense.breadth(None, 50, 100) == 100 and dense.breadth(500, None, 10, 200) == 200
    with pytest.raises(ValueError):
        dense.check_rowids(spark.createDataFrame([(0, "a"), (2, "b")], "rowid long, docno string"))


def test_prompt_and_contexts(spark):
    snippets = spark.createDataFrame([([("", "http://x/pubmed/12", 5, "t "), (None, "77", None, "u"), ("k", "", None, ""), (None, "web", None, "v")],)], "s array<struct<id:string,document:string,offset:int,text:string>>")
    got = snippets.select(evidence.given_contexts(F.col("s")).alias("c")).first().c
    assert [(c.id, c.text) for c in got] == [("12-5", "t"), ("77", "u"), ("k", ""), ("snippet-3", "v")]
    block = snippets.select(evidence.evidence_block(evidence.given_contexts(F.col("s")), 3, 1).alias("b")).first().b
    assert block == "[12-5],\nt\n\n[77],\nu\n\n[k],"


def test_generation(spark):
    rows = spark.createDataFrame([("1", "yesno", "p", 1), ("2", "", " ", 1), ("3", "", "p", 0)], "query_id string, query_type string, prompt string, n_contexts int")
    got = {r.query_id: r for r in generate.answers(rows).collect()}
    assert got["1"].error == "yesno needs exact_answer" and got["2"].error == "empty prompt" and got["3"].error == "empty prompt"

    def flaky(prompt, calls=[]):  # noqa: B006
        calls.append(1)
        if len(calls) < 2:
            raise TimeoutError("slow")
        return json.dumps({"ideal_answer": "fine", "evidence_ids": []})

    one = rows.where("query_id = '1'").withColumn("query_type", F.lit("")).coalesce(1)
    told = generate.replied(one, flaky, wait=0.0).first()
    assert told.error is None and "fine" in told.reply
    done = generate.answers(one).withColumn("run", F.lit(generate.fingerprint("a", 1)))
    assert generate.to_do(rows, done, generate.fingerprint("a", 1)).count() == 2 and generate.to_do(rows, done, "other").count() == 3


def test_readers(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"query_id": " 1 ", "query_text": "Are there?", "documents": ["http://x/pubmed/5", " "]}\n\n{"query_id": "2", "query_text": "b", "query_type": " "}\n')
    got = {r.query_id: r for r in readers.queries(spark, str(tmp_path / "q.jsonl")).collect()}
    assert got["1"].documents == ["5"] and got["2"].documents is None and got["2"].query_type is None
    for bad in ('{"questions": [1]}', "[1]", '{"query_id": "1"}', '{"query_id": "", "query_text": "x"}'):
        (tmp_path / "bad.jsonl").write_text(bad + "\n")
        with pytest.raises(Exception):
            readers.queries(spark, str(tmp_path / "bad.jsonl")).collect()
    with pytest.raises(ValueError):
        readers.queries(spark, "x.json")
    (tmp_path / "r.tsv").write_text("query_id\tdoc\trank\nq\td1\tx\nq\td2\t2\n")
    assert sorted((r.docno, r["rank"]) for r in readers.run_file(spark, str(tmp_path / "r.tsv")).collect()) == [("d1", 0), ("d2", 2)]
    (tmp_path / "s.tsv").write_text("qid\tdocno\nq\tz\nq\ta\n")
    assert lists(readers.run_file(spark, str(tmp_path / "s.tsv"))) == {"q": ["z", "a"]}
    (tmp_path / "c.jsonl").write_text('{"key": "k", "qid": "q", "context_id": "c", "doc_id": "d", "rank": 0, "ce_score": NaN, "n_claims": 0, "claims": []}\n')
    assert readers.claim_cache(spark, str(tmp_path / "c.jsonl")).first().ce_score is None
    sinks.run_tsv(run(spark, [("q", "a", 1, 1.0)]), str(tmp_path / "out"))
    assert lists(readers.run_file(spark, str(tmp_path / "out"))) == {"q": ["a"]}
    log = []
    for _ in range(2):
        sinks.once(spark, str(tmp_path / "t"), lambda: spark.range(3), log)
    assert [x for _, x in log] == ["made", "kept"]


def test_settings():
    text = "export A=1 # one\nB=\"x$A\"\nC='$A'\n# no\nD=${HOME_}/y\nWINDOW_SIZE=5\n"
    assert config.parse(text, {"HOME_": "/h"}) == {"A": "1", "B": "x1", "C": "$A", "D": "/h/y", "WINDOW_SIZE": "5"}
    assert config.Settings.read(text).window_size == 5
    assert [config.candidate_limit(*x) for x in ((10, 5000), (9000, 5000), (500, 100), (9000, 5000, 700))] == [30, 2000, 100, 700]
    with pytest.raises(ValueError):
        config.Settings(mode="direct", citations="sentence").checked()
    assert config.flag(None) is None and config.flag("off") is False and config.flag("1") is True
    assert config.ground_truth("run_b1.tsv", {}, {"x*": "p"}, {"b1": "g"}, "d") == "g"


def test_routes(spark):
    corpus = spark.createDataFrame([(str(i), f"Title {i}", f"The {w} cat sat. It saw a {w} dog there. Then it slept for long.") for i, w in enumerate(["red", "blue", "green", "grey"])], "docno string, title string, text string")
    topics = spark.createDataFrame([("q", "blue dog")], "qid string, query string")
    got = route.document_route(corpus, topics, config.Settings())
    assert lists(got)["q"][0] == "1"
    _told, docs = route.snippet_route(corpus, topics, got, config.Settings())
    assert lists(docs)["q"][0] == "1"
    contexts = spark.createDataFrame([("q", 0, "c", "d", "some text", 0.5)], "qid string, pos int, id string, doc_id string, text string, ce_score double")
    assert route.claim_route(contexts, config.Settings()).count() == 2


def test_stream_of_contexts(spark, tmp_path):
    def extract(asked):
        return asked.select("key", "qid", F.col("id").alias("context_id"))

    (tmp_path / "in").mkdir()
    line = {"qid": "q", "pos": 0, "id": "c", "doc_id": "d", "text": "t", "ce_score": 0.5}
    for i in range(3):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(line | {"text": f"t{i // 2}"}) + "\n")
        stream = claims.contexts(spark, str(tmp_path / "in"))
        claims.ingest(stream, str(tmp_path / "cache"), str(tmp_path / "ck"), extract).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "cache" / "*")).count() == 2
