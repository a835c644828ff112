"""Language identification, hard negatives and centroid clusters against brute force and on awkward rows."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from syntenia.llm import centroid_clusters, hard_negatives, language_id
from syntenia.llm.centroid_clusters import op13_sql

VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def vectors(spark, rows):
    """Rows (vec_id, embedding, label), with further columns whose names clash with those the operators use."""
    return spark.createDataFrame(rows, VECTORS).withColumn("q", F.lit(1)).withColumn("weight", F.lit("w")).withColumn("cluster", F.lit(0)).withColumn("pack", F.lit(7)).withColumn("score", F.lit(7))


def unit(rng, dim=64):
    x = np.array([rng.gauss(0, 1) for _ in range(dim)])
    return (x / np.linalg.norm(x)).astype(np.float32).tolist()


def sql(query, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    return con.execute(query).df()


def as_rows(df):
    return sorted(map(tuple, df[sorted(df.columns)].to_numpy(object).tolist()), key=str)


# ---- clusters ----------------------------------------------------------------


def lloyd(rows):
    """Clusters by whole-number arithmetic over all rows, no weights."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [q for _, q in sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())[:8]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(q, c)), k) for k, c in enumerate(centroids)) for _, q in kept]

    for _ in range(10):
        at = assign()
        for k in range(len(centroids)):
            own = [q for (_, q), a in zip(kept, at) if a[1] == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    return {(i, a[1], a[0]) for (i, _), a in zip(kept, assign())}, centroids


def cluster_rows(n=150):
    rng = random.Random(5)
    rows = [(i, unit(rng), 0) for i in range(n)]
    rows += [(n + i, rows[3][1], 1) for i in range(n)]  # a vector that half of all rows share
    return [*rows, (900, None, 0), (901, [0.1] * 63, 0), (902, [None] + [0.1] * 63, 0), (903, [math.nan] * 64, 0), (904, [math.inf] + [0.0] * 63, 0), (905, [-0.5] * 64, None), (906, [], 0)]


def test_clusters_match_unweighted_lloyd(spark):
    rows = cluster_rows()
    got = centroid_clusters.clusters(vectors(spark, rows)).collect()
    want, centroids = lloyd(rows)
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
        assert r["inertia"] == sum(x["distance"] for x in got)
        assert r["cluster_inertia"] == sum(x["distance"] for x in got if x["cluster"] == r["cluster"])


def test_clusters_query_and_sql_agree_with_a_common_vector(spark, tmp_path):
    rows = cluster_rows(40)
    spark.createDataFrame(rows, VECTORS).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = centroid_clusters.op13_weighted_clusters(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(got.dtypes)["cluster"] == "int" and dict(got.dtypes)["distance"] == "bigint"
    assert as_rows(got.toPandas()) == as_rows(sql(op13_sql(), rows))


def test_clusters_of_few_and_no_rows(spark):
    assert centroid_clusters.clusters(vectors(spark, [])).count() == 0
    assert centroid_clusters.clusters(vectors(spark, [(1, None, 0)])).count() == 0
    rng = random.Random(1)
    v = unit(rng)
    got = centroid_clusters.clusters(vectors(spark, [(1, v, 0), (1, v, 0), (2, unit(rng), 0), (None, v, 0)])).collect()
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 0)]


def test_clusters_refuse_what_a_long_cannot_hold(spark):
    with pytest.raises(Exception, match="too large for exact"):
        centroid_clusters.clusters(vectors(spark, [(1, [1e9] * 64, 0)])).collect()


# ---- hard negatives ----------------------------------------------------------


def mined(rows, every=50, low=50, high=95):
    """Every pair of rows, sorted."""
    kept = {(i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, y, q in kept:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, r)), j, z) for j, z, r in kept if j != i)
        for s, j, z in [x for x in scored if x[2] == y][:5]:
            fit = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s][:3]
            out |= {(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(fit)}
    return out


def clustered(seed, n, spread, labels=4, groups=6, norm=lambda rng: 1.0):
    rng = random.Random(seed)
    centres = [np.array(unit(rng, 16)) for _ in range(groups)]
    rows = []
    for i in range(n):
        v = centres[i % groups] + np.array([rng.gauss(0, spread) for _ in range(16)])
        rows.append((i, (v / np.linalg.norm(v) * norm(rng)).astype(np.float32).tolist(), rng.randrange(labels)))
    return rows


def columns(got):
    return {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got}


def small_blocks(monkeypatch):
    """Many blocks and packs, so that intervals, bins and bounds matter."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "PACK", 3)
    monkeypatch.setattr(hard_negatives, "PIVOTS", 5)
    monkeypatch.setattr(hard_negatives, "TILE", 64)


@pytest.mark.parametrize("norm", ["one", "many"])
def test_hard_negatives_match_all_pairs(spark, monkeypatch, norm):
    small_blocks(monkeypatch)
    rows = clustered(3, 700, 0.08, norm=(lambda rng: 1.0) if norm == "one" else (lambda rng: rng.uniform(0.1, 3)))
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(300)]  # one vector that many rows share, some of them anchors
    got = hard_negatives.mined(vectors(spark, rows)).collect()
    assert columns(got) == mined(rows) and len(got) == len(columns(got)) > 100


def test_hard_negatives_scan_less_where_vectors_cluster(spark, monkeypatch):
    small_blocks(monkeypatch)
    pairs = []
    plain = hard_negatives._pairs
    monkeypatch.setattr(hard_negatives, "_pairs", lambda *a: pairs.append(plain(*a).count()) or plain(*a))
    rows = clustered(9, 1200, 0.01)
    got = hard_negatives.mined(vectors(spark, rows)).collect()
    assert columns(got) == mined(rows)
    every = (1200 / 16) * (24 / 3)
    assert pairs[0] < 0.5 * every  # the first interval of the positives' search is a part of all blocks


def test_hard_negatives_of_awkward_rows(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, unit(rng, 8), i % 3) for i in range(120)]
    rows += [(0, rows[0][1], 0), (50, rows[50][1], 2), (None, unit(rng, 8), 1), (200, None, 1), (250, unit(rng, 8), None), (300, [None] * 8, 1), (350, [math.nan] * 8, 1), (400, [0.0] * 8, 1), (450, [], 2), (500, [0.5] * 5, 0), (550, [0.2] * 8, 99)]
    got = hard_negatives.mined(vectors(spark, rows)).collect()
    assert columns(got) == mined(rows) and len(got) == len(columns(got))
    assert hard_negatives.mined(vectors(spark, [])).count() == 0
    assert hard_negatives.mined(vectors(spark, [(1, [0.5], 0)])).count() == 0
    assert hard_negatives.mined(vectors(spark, [(50, [0.5], 0)])).count() == 0
    assert hard_negatives.mined(vectors(spark, [(50, [0.0], 0), (1, [0.0], 0), (2, [0.0], 1)])).count() == 1


def test_hard_negatives_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, unit(rng, 64), rng.randrange(10)) for i in range(300)]
    spark.createDataFrame(rows, VECTORS).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = hard_negatives.op12_hard_negatives(spark, str(tmp_path))
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    moved = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    assert columns(got.collect()) == mined(moved)
    assert columns(sql(hard_negatives.OP12_SQL, rows).to_dict("records")) == mined(moved)


# ---- languages ---------------------------------------------------------------

SYLLABLES = {"aa": "ka to mi ru se no ha", "bb": "str ung ich ver ent gen", "cc": "eau oui ment tion elle"}


def prose(rng, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(n))


def phrases(sample, text):
    """Greedy longest matches by substring search; a byte that the sample lacks is a phrase of its own."""
    fold = lambda b: bytes(language_id.FOLDED[np.frombuffer(b, np.uint8)].astype(np.uint8))
    sample, text = fold(sample), fold(text)
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_match_substring_search():
    rng = random.Random(4)
    for alphabet in ("ab", "abcdé ", "xyzß漢 9"):
        sample = "".join(rng.choice(alphabet) for _ in range(400)).encode()
        a = language_id.Automaton(sample)
        texts = ["".join(rng.choice(alphabet + "q") for _ in range(n)).encode() for n in (300, 80, 80, 7, 1)]
        ends = np.cumsum([0, *map(len, texts)])
        size = np.diff(ends)
        order = np.argsort(-size, kind="stable")
        got = a.phrases(np.frombuffer(b"".join(texts), np.uint8), ends[:-1][order], size[order])
        assert got.tolist() == [phrases(sample, texts[i]) for i in order]


def language_docs(spark, n=240, seed=6):
    rng = random.Random(seed)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    rows = [(i, prose(rng, x, rng.choice([4, 30, 200])), x, "s", 1) for i, x in enumerate(langs)]
    return rows, spark.createDataFrame(rows, DOCS)


def test_held_out_languages_are_found(spark):
    rows, d = language_docs(spark)
    got = {r["doc_id"]: r for r in language_id.languages(d).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == {r[0] for r in out} and len(out) > 30
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_entropy_matches_a_plain_parse(spark):
    rows, d = language_docs(spark, 60)
    samples = language_id.samples_by_language(d)
    for r in language_id.languages(d).collect():
        text = rows[r["doc_id"]][1].lower().encode()
        cut = [text[i : i + language_id.PIECE] for i in range(0, len(text), language_id.PIECE)]
        h = {k: sum(phrases(s, p) for p in cut) * math.log2(len(s)) / len(text) for k, s in samples.items()}
        best = min(sorted(h), key=h.get)
        assert r["lang_pred"] == best and math.isclose(r["bits"], h[best])
        assert math.isclose(r["score"], 1 - h[best] / sorted(h.values())[1], abs_tol=1e-12)


def test_prediction_reads_neither_lang_nor_held_out_rows(spark):
    rows, d = language_docs(spark)
    lied = d.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    pick = lambda x: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.languages(x).collect())
    assert pick(d) == pick(lied)


def test_languages_of_awkward_rows(spark):
    rows, d = language_docs(spark, 120)
    odd = [(500, None, "aa", None, 0), (501, "", "bb", None, 0), (502, "12 +-*/ \n 7", "cc", None, 0), (503, prose(random.Random(1), "cc", 60_000), None, None, 0), (None, "kato miru", None, None, 0), (504, "KATO MIRU SENO HATO", None, None, 0), (504, "KATO MIRU SENO HATO", None, None, 0), (505, "漢", None, None, 0)]
    clash = spark.createDataFrame(odd, DOCS).union(d).withColumn("bytes", F.lit(1)).withColumn("held_out", F.lit("x")).withColumn("h", F.lit(2))
    got = language_id.languages(clash).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by[503]["lang_pred"] == "cc" and by[504]["lang_pred"] == "aa" and by[505]["lang_pred"] in SYLLABLES
    assert by[None]["held_out"] is False and sum(r["doc_id"] == 504 for r in got) == 2
    assert language_id.languages(spark.createDataFrame([], DOCS)).count() == 0
    unlabelled = language_id.languages(spark.createDataFrame(odd, DOCS).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"} and len(unlabelled) == len(odd)


def test_languages_query(spark, tmp_path):
    _, d = language_docs(spark, 80)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    got = language_id.op11_language_id(spark, str(tmp_path))
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    assert got.count() == 80
