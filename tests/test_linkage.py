"""Operators on small tables with results worked out by hand, and the whole chain."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from weft import schemas
from weft.functions import similarity
from weft.functions.text import normalised
from weft.operators import blocking, decide, dictionary, features, validate
from weft.plans import model as models
from weft.plans import pipeline
from weft.sources import files
from weft.streaming.linking import link_stream


def part(spark, rows):
    return spark.createDataFrame([("p", i, t) for i, t in rows], "part string, id string, name_compact string")


def test_tfidf_cosine_golden(spark):
    b, a = part(spark, [("b1", "abcd"), ("b2", "abce")]), part(spark, [("a1", "abcd"), ("a2", "abcx")])
    got = {(r.a_id, r.b_id): r.sim for r in blocking.channel_scores(a, b, blocking.NAME).collect()}
    assert got == {("a1", "b1"): pytest.approx(1.0), ("a1", "b2"): pytest.approx(0.336097, abs=1e-6), ("a2", "b1"): pytest.approx(0.579739, abs=1e-6), ("a2", "b2"): pytest.approx(0.579739, abs=1e-6)}


def test_common_terms_are_dropped_in_large_partitions_only(spark):
    postings = spark.createDataFrame([("p", str(k), t) for k in range(20) for t in ("all", f"own{k}")], "part string, id string, term string")
    sizes = spark.createDataFrame([("p", 20)], "part string, size long")
    assert blocking.document_frequency(postings, sizes).count() == 21
    assert blocking.document_frequency(postings, sizes, small=10).count() == 20


def test_wide_partition_joins_few_rows(spark):
    """Terms that all records of a partition hold aren't what pairs are found by, and every pair is found."""
    rng = random.Random(3)
    shared = [f"all{k}" for k in range(3)]
    text = lambda: " ".join(shared + [f"w{rng.randint(0, 400)}" for _ in range(9)])
    one, two = [(f"a{k}", text()) for k in range(300)], [(f"b{k}", text()) for k in range(300)]
    two += [(f"c{k}", t if k % 2 else t.replace("all0 ", "")) for k, (_, t) in enumerate(one[:100])]
    a, b = (spark.createDataFrame([("p", i, t) for i, t in rows], "part string, id string, addr_text string") for rows in (one, two))
    got = {(r.a_id, r.b_id): r.sim for r in blocking.channel_scores(a, b, blocking.ADDRESS).collect()}
    df = {}
    for _, t in two:
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1

    def vector(t):
        raw = {w: (1 + math.log(t.split().count(w))) * (math.log((1 + len(two)) / (1 + df[w])) + 1) for w in set(t.split()) if w in df}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}

    va, vb = ({i: vector(t) for i, t in rows} for rows in (one, two))
    sims = {(i, j): round(sum(x * vb[j].get(w, 0) for w, x in va[i].items()), 6) for i in va for j in vb}
    expected = {k: s for k, s in sims.items() if s > blocking.ADDRESS.threshold}
    assert got.keys() == expected.keys() and all(abs(got[k] - s) < 2e-6 for k, s in expected.items()) and len(got) > 100
    idf = blocking.document_frequency(blocking.terms(b, "addr_text", None), spark.createDataFrame([("p", len(two))], "part string, size long"))
    wa, wb = (blocking.divided(blocking.weights(blocking.terms(x, "addr_text", None), idf), blocking.ADDRESS.threshold) for x in (a, b))
    rows = lambda x, y: x.select("term").join(y.select("term"), "term").count()
    assert rows(wa.filter("rare"), wb.filter("rare")) < 0.1 * rows(wa, wb)


def test_group_threshold_search(spark):
    rng = random.Random(8)
    rows = [(f"a{rng.randint(0, 30)}", f"b{rng.randint(0, 40)}", rng.randint(0, 10) / 10, rng.randint(0, 2)) for _ in range(300)]
    rows = list({(a, b): (a, b, p, g) for a, b, p, g in rows}.values())
    truth = [(a, b) for a, b, p, _ in rows if rng.random() < p * 0.7]
    people = [f"a{k}" for k in range(32)]
    grid = [0.3, 0.5, 0.7, 0.9]

    def score(limits, one_to_one):
        kept = sorted(((-p, a, b) for a, b, p, g in rows if p >= limits[g]))
        best = {}
        for p, a, b in kept:
            best.setdefault(b if one_to_one else (a, b), (a, b))
        found, total = set(best.values()), 0.0
        for a in people:
            t, m = {b for x, b in truth if x == a}, {b for x, b in found if x == a}
            hits = len(t & m)
            total += 1.0 if not t and not m else 1.25 * (hits / len(m)) * (hits / len(t)) / (0.25 * hits / len(m) + hits / len(t)) if hits else 0.0
        return total / len(people)

    scored = spark.createDataFrame(rows, "a_id string, b_id string, p double, g int")
    real, them = spark.createDataFrame(truth, "a_id string, b_id string"), spark.createDataFrame([(a,) for a in people], "a_id string")
    for one_to_one in (True, False):
        limits = dict.fromkeys((0, 1, 2), 0.5)
        best = score(limits, one_to_one)
        for _ in range(2):
            for g in (0, 1, 2):
                for value in grid:
                    new = score(limits | {g: value}, one_to_one)
                    if new > best + 1e-6:
                        limits, best = limits | {g: value}, new
        groups, found = decide.group_thresholds(scored, real, them, 0.5, one_to_one, grid)
        assert groups == limits and found == pytest.approx(best)


def record(i, name, address, state="TX", country="US"):
    return (i, name, address, country)


def sides(spark, raw_a, raw_b):
    make = lambda rows: normalised(spark.createDataFrame(rows, schemas.RAW))
    return make(raw_a), make(raw_b)


def test_records_without_state_meet_every_partition(spark):
    a, b = sides(spark, [("S1-1", "Acme Tools", "1 Oak St, Dallas, TX", "US"), ("S1-2", "Acme Tools", "1 Oak St, Albany, NY", "US"), ("S1-3", "Acme Tools", "1 Oak St", "US")], [("S2-1", "Acme Tools", "1 Oak St", "US"), ("S2-2", "Acme Tools", "1 Oak St, Dallas, TX", "US"), ("S3-3", "Acme Tools", None, "France")])
    got = {(r.a_id, r.b_id) for r in blocking.candidate_pairs(a, b).collect()}
    assert got == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S2-1"), ("S1-3", "S2-1"), ("S1-3", "S2-2")}


def test_wider_settings_retrieve_more(spark):
    random.seed(3)
    words = ["".join(random.choices("abcdef", k=5)) for _ in range(12)]
    rows = lambda p, n: [(f"{p}-{k}", " ".join(random.choices(words, k=2)), f"{k} Oak St, Dallas, TX", "US") for k in range(n)]
    a, b = sides(spark, rows("S1", 15), rows("S2", 30))
    few = {(r.a_id, r.b_id) for r in blocking.candidate_pairs(a, b, (blocking.Channel("sim_name", "name_compact", 3, 0.3, 2, 1),)).collect()}
    many = {(r.a_id, r.b_id) for r in blocking.candidate_pairs(a, b, (blocking.Channel("sim_name", "name_compact", 3, 0.0, 50, 50),)).collect()}
    assert few < many
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = {(r.a_id, r.b_id) for r in blocking.candidate_pairs(a, b, (blocking.Channel("sim_name", "name_compact", 3, 0.3, 2, 1),)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert again == few


def test_decision_goldens(spark):
    rows = spark.createDataFrame([("s1", "c1", 0.90), ("s2", "c1", 0.95), ("s1", "c2", 0.70), ("s2", "c3", 0.60)], "a_id string, b_id string, p double")
    assert {(r.a_id, r.b_id) for r in decide.decided(rows, 0.68).collect()} == {("s2", "c1"), ("s1", "c2")}
    grouped = rows.withColumn("g", F.lit(1))
    assert decide.decided(grouped, 0.5, groups={1: 0.92}).count() == 1
    # the best pair of a B fails in its own group, so a lesser one wins
    two = spark.createDataFrame([("s1", "c1", 0.9, 7), ("s2", "c1", 0.8, 0)], "a_id string, b_id string, p double, g int")
    assert [r.a_id for r in decide.decided(two, 0.5, groups={7: 0.95}).collect()] == ["s2"]
    key = spark.range(1).select(decide.group_key(F.lit(1), F.lit(3), F.lit(1)), decide.group_key(F.lit(0), F.lit(1), F.lit(5))).first()
    assert tuple(key) == (7, 0)


def test_macro_f_half_golden(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a_id string, b_id string")
    people = spark.createDataFrame([("a",), ("b",), ("c",)], "a_id string")
    truth = frame([("a", "1"), ("a", "2"), ("c", "3")])
    assert decide.macro_f_half(truth, frame([("a", "1")]), people).first()[0] == pytest.approx((0.8333333 + 1) / 3)
    assert decide.macro_f_half(truth, frame([("a", "1"), ("b", "9"), ("z", "1")]), people).first()[0] == pytest.approx(0.8333333 / 3)
    assert decide.macro_f_half(truth, truth, people).first()[0] == 1
    scored = frame([("a", "1"), ("b", "9")]).withColumn("p", F.when(F.col("a_id") == "a", 0.9).otherwise(0.4))
    sweep = {r.threshold: r.macro_f05 for r in decide.threshold_sweep(scored, truth, people, [0.3, 0.5]).collect()}
    assert sweep == {0.3: pytest.approx(0.8333333 / 3), 0.5: pytest.approx(1.8333333 / 3)}


def test_second_best_counts_ties(spark):
    rows = spark.createDataFrame([("a", "1", 0.9), ("a", "2", 0.9), ("a", "3", 0.2), ("b", "1", 0.4)], "a_id string, b_id string, p double")
    got = {(r.a_id, r.b_id): r.p_second for r in features.stack_features(rows).collect()}
    assert got == {("a", "1"): 0.9, ("a", "2"): 0.9, ("a", "3"): 0.9, ("b", "1"): 0.0}


def test_pair_feature_sentinels(spark):
    a, b = sides(spark, [("S1-1", "Acme Tools", None, "US")], [("S2-1", "Acme Tools", "5 Oak St, Dallas, TX", "US"), ("S2-2", "Zebra", "", "US")])
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9, 0.0), ("S1-1", "S2-2", 0.1, 0.0)], schemas.PAIRS)
    rows = {r.b_id: r for r in features.pair_features(pairs, a, b).collect()}
    assert [f for f in schemas.FEATURES if rows["S2-1"][f] is None] == []
    assert len(schemas.FEATURES) == 56
    one = rows["S2-1"]
    assert (one.a_ratio, one.a_jacc, one.a_num_jacc, one.a_num_inter, one.house_rel, one.house_ratio, one.state_rel, one.amb_addr) == (-1, -1, -1, 0, 0, -1, 0, 0)
    assert (one.n_ratio, one.n_cmp_eq, one.n_cands, one.n_tsr_rank, rows["S2-2"].n_tsr_rank) == (100, 1, 2, 1, 2)


def test_lcs_in_sql_agrees(spark):
    random.seed(1)
    rows = [("".join(random.choices("abc", k=random.randint(0, 9))), "".join(random.choices("abc", k=random.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "x string, y string")
    for r in df.select("x", "y", similarity.lcs_expression(F.col("x"), F.col("y")).alias("n")).collect():
        assert r.n == similarity.lcs(r.x, r.y)


def test_spellings(spark):
    pairs = spark.createDataFrame([("Ram Traders", "राम ट्रेडर्स")] * 2 + [("Ram Stores Ltd", "राम"), ("Sita", "राम सीता"), (None, None)], "latin_name string, native_name string")
    got = {r.native: (r.latin, r.w) for r in dictionary.spellings(dictionary.aligned(dictionary.tokenised(pairs))).collect()}
    assert got == {"राम": ("ram", 2.5), "ट्रेडर्स": ("traders", 2.0)}


def test_validation(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S3-2"), ("S1-2", "S1-5,X-1"), ("S1-9", ""), ("S1-3", None)], "k string, ids string")
    need = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",), ("S1-4",)], "id string")
    candidates = spark.createDataFrame([("S1-1", "S2-1")], "k string, ids string")
    got = {r.check: (r.severity, r.n, r.examples) for r in validate.validated(lists, "k", "ids", need, candidates=candidates).collect()}
    assert got["duplicate key"][1:] == (1, ["S1-1"]) and got["duplicate id in a list"][1:] == (1, ["S1-1"])
    assert got["id of the key's own source"][2] == ["S1-5"] and got["id with a wrong prefix"][2] == ["X-1"]
    assert got["missing key"][2] == ["S1-4"] and got["unexpected key"][2] == ["S1-9"]
    assert got["match outside the candidates"][0] == "warning" and got["match outside the candidates"][1] == 3
    assert validate.header_issue("a,b", ["a", "b"]) == "commas" and validate.header_issue("A\t B", ["a", "b"]) is None
    assert validate.header_issue("", ["a"]) == "empty" and validate.header_issue("a\tc", ["a", "b"]) == "header"
    paths = [str(tmp_path / n) for n in ("m.tsv", "c.tsv", "s.tsv")]
    for path, text in zip(paths, ("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n", "source1_entity_id\tcandidate_entity_ids\nS1-1\t\n", "entity_id\tbusiness_name\nS1-1\tx\n\n"), strict=True):
        with open(path, "w") as f:
            f.write(text)
    code, messages = validate.validate_files(spark, *paths)
    assert code == 0 and len(messages) == 1 and messages[0].startswith("warning")
    assert validate.validate_files(spark, paths[2], paths[1], paths[2])[0] == 1
    assert validate.validate_files(spark, str(tmp_path / "none.tsv"), paths[1], paths[2])[0] == 1


def test_tsv_keeps_quotes_and_backslashes(spark, tmp_path):
    rows = spark.createDataFrame([("S1-1", 'a "b" \\c', "", "US"), ("S1-2", "x", None, "US")], schemas.RAW)
    path = str(tmp_path / "t.tsv")
    files.write_tsv(rows, path, single=True)
    assert {tuple(r) for r in files.read_tsv(spark, path).collect()} == {("S1-1", 'a "b" \\c', "", "US"), ("S1-2", "x", "", "US")}
    text = "".join(p.read_text() for p in (tmp_path / "t.tsv").glob("part-*"))
    assert '""' not in text and text.count("entity_id") == 1
    (tmp_path / "bad.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tonly\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED"):
        files.read_tsv(spark, str(tmp_path / "bad.tsv")).collect()


def test_stage_resumes(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert files.stage(spark, str(tmp_path / "x"), make).count() == 3
    assert len(made) == 1
    files.write_json(spark, {"a": [1, "é"]}, str(tmp_path / "j"))
    assert files.read_json(spark, str(tmp_path / "j")) == {"a": [1, "é"]}


def world(n=60):
    """Clean entities, and noisy copies of them in two other sources."""
    random.seed(5)
    syllables = ["ka", "lo", "mi", "ren", "tos", "vel", "dar", "sun", "pra", "gim"]
    word = lambda: "".join(random.choices(syllables, k=3)).title()
    a, b, truth = [], [], []
    for k in range(n):
        name, street, house = f"{word()} {word()}", word(), random.randint(1, 99)
        state = random.choice(["TX", "NY", "CA"])
        a.append((f"S1-{k}", f"{name} Inc", f"{house} {street} Street, Town, {state}", "US"))
        ids = []
        for s in range(random.randint(0, 2)):
            noisy = name.replace("a", "e", 1) if random.random() < 0.3 else name
            i = f"S{2 + s}-{k}"
            ids.append(i)
            b.append((i, f"{noisy} LLC", f"{house} {street} St, {state}" if random.random() < 0.8 else "", "US"))
        truth.append((f"S1-{k}", ",".join(ids)))
    b += [(f"S3-{1000 + k}", f"{word()} {word()}", f"{k} Elm Ave, Town, TX", "US") for k in range(30)]
    return a, b, truth


def test_whole_chain(spark, tmp_path):
    a, b, truth = world()
    paths = {n: str(tmp_path / f"{n}.tsv") for n in ("a", "b", "truth")}
    for name, rows, schema in (("a", a, schemas.RAW), ("b", b, schemas.RAW), ("truth", truth, schemas.TRUTH)):
        files.write_tsv(spark.createDataFrame(rows, schema), paths[name], single=True)
    config = pipeline.train(spark, str(tmp_path / "work"), paths["a"], [paths["b"]], paths["truth"], rounds=8, depth=3, tune_groups=False)
    assert config.macro_f05 > 0.6 and config.ceiling >= config.macro_f05 and config.importance
    loaded = models.load(spark, str(tmp_path / "work/first"))[1]
    assert loaded.threshold == config.threshold
    pipeline.predict(spark, str(tmp_path / "run"), str(tmp_path / "work"), paths["a"], [paths["b"]], str(tmp_path / "out"))
    lists = files.read_lists(spark, str(tmp_path / "out/matching_results.tsv"), files.MATCHES)
    assert lists.count() == len(a)
    matched = decide.truth_pairs(lists)
    assert matched.groupBy("b_id").count().filter("count > 1").count() == 0
    people = lists.select(F.col("source1_entity_id").alias("a_id"))
    real = decide.truth_pairs(spark.createDataFrame(truth, schemas.TRUTH))
    assert decide.macro_f_half(real, matched, people).first()[0] > 0.6
    code, _ = validate.validate_files(spark, str(tmp_path / "out/matching_results.tsv"), str(tmp_path / "out/candidate_pairs.tsv"), paths["a"], [paths["b"]])
    assert code == 0

    from weft.__main__ import main

    given = ["--a", paths["a"], "--b", paths["b"]]
    assert main(["features", "--work", str(tmp_path / "part"), *given, "--truth", paths["truth"], "--sample", "0.5", "--top-name", "2", "--country", "US"]) == 0
    some, every = (files.read_parquet(spark, str(tmp_path / n)) for n in ("part/features-US", "work/features"))
    assert 0 < some.select("a_id").distinct().count() < every.select("a_id").distinct().count()
    assert main(["predict", "--work", str(tmp_path / "run"), "--model", str(tmp_path / "work"), *given, "--out", str(tmp_path / "first"), "--stage", "first", "--country", "US"]) == 0
    assert files.read_lists(spark, str(tmp_path / "first/matching_results.tsv"), files.MATCHES).count() == len(a)
    assert main(["validate", str(tmp_path / "first/matching_results.tsv"), str(tmp_path / "first/candidate_pairs.tsv"), "--required", paths["a"]]) == 0

    side = files.read_parquet(spark, str(tmp_path / "work/a"))
    arriving = spark.readStream.schema(schemas.RAW).csv(paths["b"], sep="\t", header=True, quote="")
    model, config = models.load(spark, str(tmp_path / "work/first"))
    link_stream(arriving.na.fill(""), side, model, config, str(tmp_path / "live"), str(tmp_path / "cp")).awaitTermination()
    live = spark.read.parquet(str(tmp_path / "live"))
    assert live.count() > 0 and live.groupBy("b_id").count().filter("count > 1").count() == 0


def test_plans_have_no_cartesian_product(spark):
    a, b = sides(spark, *world(20)[:2])
    plan = features.pair_features(blocking.candidate_pairs(a, b), a, b)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
