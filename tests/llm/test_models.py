"""Quality, language, top-k, mixing and the pipeline: brute force, held-out accuracy and odd inputs."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from comparison import connect, mismatch
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from pacewell.llm import common, language, mixing, quality, topk
from pacewell.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def accuracy(df, labels, predicted, truth):
    rows = df.filter("held_out").join(labels, "doc_id").filter(F.col(truth).isNotNull())
    return rows.agg(F.avg((F.col(predicted) == F.col(truth)).cast("int"))).first()[0]


def test_quality_held_out(spark):
    out = quality.op2_quality(spark, MIDDLE).cache()
    assert out.count() == 1000 and out.filter("NOT score BETWEEN 0 AND 1 OR predicted <> cast(score >= 0.7 AS int)").isEmpty()
    assert accuracy(out, common.table(spark, MIDDLE, "labels"), "predicted", "quality") > 0.95


def test_quality_learns_pairs_and_one_sided_labels():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.learn(x, y)
    fresh = rng.random((1000, 4))
    assert ((model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))).mean() > 0.93
    assert (0, 1) in [p[:2] for p in model.pairs]
    assert set(quality.learn(x, np.ones(3000)).score(fresh)) == {quality.learn(x, np.ones(3000)).score(fresh[:1])[0]}
    assert quality.learn(x[:0], y[:0]).score(fresh[:1])[0] == pytest.approx(0.5)


def slow_boosting(x, y, how):
    """The same model by loops over rows and cuts: (score of a row, pairs)."""
    n, wide = len(x), len(x[0])
    share = (sum(y) + 0.5) / (n + 1.0)
    start = float(np.log(share / (1 - share)))
    cuts = [sorted(set(np.quantile([r[i] for r in x], np.linspace(0, 1, quality.BINS + 1)[1:-1]).tolist())) for i in range(wide)]
    bin_of = lambda i, v: sum(c <= v for c in cuts[i])
    small_of = lambda i, v: bin_of(i, v) * quality.PAIR_BINS // (len(cuts[i]) + 1)
    tables, total = [[0.0] * (len(c) + 1) for c in cuts], [start] * n

    def gradients():
        p = [1 / (1 + np.exp(-t)) for t in total]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    def gain(g, h):
        return g * g / (h + how.ridge)

    def best(cells):
        """(gain, first cell on the right) of a list of (g, h)."""
        found = (-np.inf, 0)
        for at in range(1, len(cells)):
            (lg, lh), (rg, rh) = ([sum(c[k] for c in side) for k in (0, 1)] for side in (cells[:at], cells[at:]))
            if lh >= how.least_weight and rh >= how.least_weight:
                won = gain(lg, lh) + gain(rg, rh) - gain(lg + rg, lh + rh)
                if won > found[0] + 1e-12:
                    found = (won, at)
        return found

    def leaf(cells):
        return how.rate * sum(c[0] for c in cells) / (sum(c[1] for c in cells) + how.ridge)

    def cells_of(keys, size):
        g, h = gradients()
        cells = [[0.0, 0.0] for _ in range(size)]
        for k, a, b in zip(keys, g, h):
            cells[k][0] += a
            cells[k][1] += b
        return cells

    for _ in range(how.rounds):
        for i in range(wide):
            keys = [bin_of(i, r[i]) for r in x]
            cells, edges = cells_of(keys, len(tables[i])), [0, len(tables[i])]
            for _ in range(2):
                won, at, first = max((*best(cells[a:b]), a) for a, b in zip(edges, edges[1:]))
                if won <= 0:
                    break
                edges = sorted([*edges, first + at])
            step = [leaf(cells[a:b]) for a, b in zip(edges, edges[1:]) for _ in range(a, b)]
            tables[i] = [t + s for t, s in zip(tables[i], step)]
            total = [t + step[k] for t, k in zip(total, keys)]

    def pair_tree(a, b):
        width = quality.PAIR_BINS
        flat = cells_of([small_of(a, r[a]) * width + small_of(b, r[b]) for r in x], width * width)
        grid = [flat[i * width : (i + 1) * width] for i in range(width)]
        across = lambda rows: [[sum(r[j][k] for r in rows) for k in (0, 1)] for j in range(width)]
        won, at = best([[sum(c[k] for c in row) for k in (0, 1)] for row in grid])
        halves = [(0, at), (at, width)] if won > 0 else [(0, width)]
        all_won, step = max(won, 0.0), [[0.0] * width for _ in range(width)]
        for first, end in halves:
            cells = across(grid[first:end])
            won, cut = best(cells)
            for c0, c1 in [(0, cut), (cut, width)] if won > 0 else [(0, width)]:
                for i in range(first, end):
                    step[i][c0:c1] = [leaf(cells[c0:c1])] * (c1 - c0)
            all_won += max(won, 0.0)
        return all_won, step

    chosen = sorted((-pair_tree(a, b)[0], a, b) for a in range(wide) for b in range(a + 1, wide))[: how.pairs]
    pairs = {(a, b): np.zeros((quality.PAIR_BINS,) * 2) for _, a, b in chosen}
    for _ in range(how.pair_rounds):
        for a, b in pairs:
            step = np.array(pair_tree(a, b)[1])
            pairs[a, b] += step
            total = [t + step[small_of(a, r[a]), small_of(b, r[b])] for t, r in zip(total, x)]

    def score(row):
        own = start + sum(tables[i][bin_of(i, v)] for i, v in enumerate(row))
        own += sum(t[small_of(a, row[a]), small_of(b, row[b])] for (a, b), t in pairs.items())
        return 1 / (1 + np.exp(-own))

    return score, list(pairs)


def test_quality_equals_slow_boosting():
    rng = np.random.default_rng(5)
    x = np.round(rng.random((160, 3)), 2)
    y = (((x[:, 0] > 0.4) ^ (x[:, 1] > 0.6)) | (x[:, 2] > 0.9)).astype(float)
    how = quality.Boosting(rounds=4, pair_rounds=3, pairs=2)
    model, (score, pairs) = quality.learn(x, y, how), slow_boosting(x.tolist(), y.tolist(), how)
    assert [p[:2] for p in model.pairs] == pairs
    fresh = np.round(rng.random((100, 3)), 3)
    assert model.score(fresh).tolist() == pytest.approx([score(r) for r in fresh.tolist()], abs=1e-9)


def test_quality_query_scores_are_plain_sums(spark):
    """Every score of the query against its model's tables, added up entry by entry."""
    found = common.stored(quality.features(common.table(spark, SMALL, "documents")), "test-features")
    model = quality.fit(found, quality.training_labels(spark, SMALL))
    rows = {r["doc_id"]: r["features"] for r in found.collect()}
    scored = {r["doc_id"]: r["score"] for r in quality.op2_quality(spark, SMALL).collect()}
    assert scored.keys() == rows.keys()
    for doc_id, values in rows.items():
        bins = [sum(c <= v for c in cuts) for cuts, v in zip(model.cuts, values)]
        total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
        total += sum(t[model.coarse[a][bins[a]], model.coarse[b][bins[b]]] for a, b, t in model.pairs)
        assert scored[doc_id] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_quality_of_odd_rows(spark, documents, odd_rows):
    found = quality.features(documents(odd_rows))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None), (6, 0), (99, 1)], "doc_id long, label int")
    scored = quality.scores(found, quality.fit(found, labels)).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.scores(quality.features(documents([])), quality.fit(found, labels)).count() == 0
    assert quality.fit(quality.features(documents([])), labels).score(np.zeros((1, len(quality.FEATURES))))[0] == pytest.approx(0.5)


def test_features_by_hand():
    row = dict(zip(quality.FEATURES, quality.text_features(pa.array(["Ab ab ab!! ###\nAb ab ab!! ###"]))[0]))
    assert row["log_words"] == pytest.approx(np.log1p(8)) and row["repeated_lines"] == 0.5
    assert row["distinct"] == pytest.approx(4 / 8) and row["commonest"] == pytest.approx(2 / 8) and row["bare_words"] == pytest.approx(2 / 8)
    assert not quality.text_features(pa.array([None, "", " \n "]))[:2].any()


def test_language_held_out(spark):
    out = language.op8_language(spark, MIDDLE).cache()
    assert out.count() == 1000 and out.filter("NOT score BETWEEN 0 AND 1").isEmpty()
    assert accuracy(out, common.table(spark, MIDDLE, "documents").select("doc_id", "lang"), "lang_pred", "lang") > 0.95


def test_language_scores_equal_plain_bayes(documents):
    rows = [(1, "aab é", "x", None), (2, "bbc", "y", None), (3, "AAb", "x", None), (4, None, "y", None), (5, "zz", None, None)]
    model = language.fit(documents(rows))
    assert model.languages == ["x", "y"] and np.exp(model.priors).tolist() == [0.5, 0.5]
    names, scores = model.score(pa.array(["aab", "bbc", "", None, "123", "aab"]))
    assert names == ["x", "y", "und", "und", "und", "x"] and scores[2:5].tolist() == [0, 0, 0] and scores[0] == scores[5]
    # The posterior of one text, gram by gram.
    (_, _, bounds, orders), = language.grams(pa.array(["aab"]))
    logs = [p + sum(model.table[at][b] for bucket in orders for b in bucket) for at, p in enumerate(model.priors)]
    assert scores[0] == pytest.approx(1 / (1 + np.exp(logs[1] - logs[0])), abs=1e-6)
    assert sum((b < language.BUCKETS).sum() for b in orders) == 3 + 2 + 1 and bounds.tolist() == [0, 3]


def test_language_counts_by_hand(documents):
    """Every count of the table from own loops over characters."""
    rows = [(1, "Aab é1b", "x", None), (2, "bbc bb", "y", None), (3, "", "x", None), (4, None, "y", None), (5, "ΣΑΣ 日本", "z", None)]
    model = language.fit(documents(rows))
    assert model.languages == ["x", "y", "z"]

    def buckets(text):
        plain = [c.lower() if c.isalpha() else " " for c in text or ""]
        for n in language.ORDERS:
            for i in range(len(plain) - n + 1):
                key = 0
                for k, c in enumerate(plain[i : i + n], 1):
                    key = (key * 0x01000193 + ord(c) + k) % 2**32
                yield (key * 0x9E3779B1 % 2**32) >> 18

    for at, name in enumerate(model.languages):
        counts = np.full(language.BUCKETS, language.SMOOTHING)
        for _, text, lang, _ in rows:
            for b in buckets(text) if lang == name else ():
                counts[b] += 1
        assert model.table[at, : language.BUCKETS].tolist() == pytest.approx(np.log(counts / counts.sum()).tolist(), abs=1e-5)
    assert np.exp(model.priors).tolist() == pytest.approx([2 / 5, 2 / 5, 1 / 5])


def test_language_of_odd_rows(documents, odd_rows):
    got = language.predict(documents(odd_rows), language.fit(documents(odd_rows))).collect()
    assert len(got) == len(odd_rows)
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) for r in got)
    empty = language.fit(documents([]))
    assert {r["lang_pred"] for r in language.predict(documents(odd_rows), empty).collect()} == {"und"}
    assert language.predict(documents([]), empty).count() == 0


def brute_top(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-int(np.dot(np.array(v, object), np.array(w, object))) if v else 0, i) for i, w in vectors if i != q and len(w) == len(v))
        out += [(q, at, i, -s) for at, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("dim,spread,pivots", [(3, 4, 5), (8, 300, 64), (1, 2, 2)])
def test_top_k_against_brute_force(spark, dim, spread, pivots, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 16)
    rng = random.Random(dim)
    rows = [(i, [rng.randint(-spread, spread) for _ in range(dim)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, []), (2001, []), (2002, [1] * (dim + 1))]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    wanted = brute_top(rows, [r for r in rows if r[0] % 20 == 0], 5)
    got = topk.nearest(df, df.filter("vec_id % 20 = 0"), 5, pivots)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == wanted


def test_top_k_of_odd_vectors(spark):
    common.importable(spark)
    nan, inf = float("nan"), float("inf")
    raw = [(0, [1.0, 2.0], "x"), (1, [0.5, -0.5], "x"), (2, None, "x"), (3, [None, 1.0], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"), (6, [-0.001, 1e12], "x"), (7, [3.0], "x")]
    df = spark.createDataFrame(raw, "vec_id long, embedding array<double>, score string")
    ready = topk.integers(df)
    assert {r["vec_id"]: r["v"] for r in ready.collect()} == {0: [256, 512], 1: [128, -128], 6: [-1, 256 * 10**12], 7: [768]}
    got = topk.nearest(ready, ready.filter("vec_id = 0")).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 6, -256 + 512 * 256 * 10**12), (2, 1, 256 * 128 - 512 * 128)]
    assert topk.nearest(ready.limit(0), ready.limit(0)).count() == 0
    assert topk.nearest(ready, ready.limit(0)).count() == 0


def test_knapsack_is_nearest():
    rng = random.Random(2)
    for _ in range(60):
        sizes = sorted(rng.sample(range(1, 40), rng.randint(1, 5)))
        counts = [rng.randint(0, 3) for _ in sizes]
        budget = rng.randint(0, 120)
        taken = mixing.knapsack(np.array(sizes), np.array(counts), budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        sums = {sum(s * n for s, n in zip(sizes, some)) for some in product(*[range(c + 1) for c in counts])}
        assert abs(int((taken * sizes).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert mixing.targets([10, 500, 500], [3, 1, 1]) == pytest.approx([30, 490, 490])
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.choice([0, 1, 50, 1000]) for _ in range(rng.randint(1, 8))]
        got = mixing.targets(sizes, mixing.cyclic_weights(len(sizes)))
        assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))


def test_mix_meets_targets(documents):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 3, 3, 17, 80])), "en", rng.choice(["é", "a", "B", None])) for i in range(400)]
    out = mixing.mix(documents(rows)).collect()
    sizes = {i: len(t.split()) for i, t, _, _ in rows}
    of = {i: s for i, _, _, s in rows}
    totals = Counter()
    for i, s in of.items():
        totals[s] += sizes[i]
    order = ["B", "a", "é", None]
    wanted = dict(zip(order, mixing.targets([totals[s] for s in order], [1, 2, 3, 1])))
    taken = Counter()
    for r in out:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == totals[of[r["doc_id"]]]
        assert r["target"] == pytest.approx(wanted[of[r["doc_id"]]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[of[r["doc_id"]]] += r["taken"]
    assert len(out) == 400 and all(abs(taken[s] - wanted[s]) <= 1 for s in order)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(documents(rows).repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in out}


def test_mix_of_odd_rows(documents, odd_rows):
    out = mixing.mix(documents(odd_rows)).collect()
    assert len(out) == len(odd_rows) and all(r["taken"] == 0 for r in out if r["doc_id"] in (2, 3, 4))
    mixed = mixing.mixed_documents(documents(odd_rows))
    assert mixed.columns == documents(odd_rows).columns
    assert sum(len(r["text"].encode().split()) for r in mixed.collect()) == sum(r["taken"] for r in out)
    assert mixing.mix(documents([])).count() == 0 and mixing.mixed_documents(documents([])).count() == 0


def test_mixed_rows_keep_their_own_columns(documents):
    rows = [(1, "some words stand here", "en", "a"), (1, "some words stand here", "fr", "a"), (1, "some words stand here", None, "a"), (2, "others are here", "en", "b")]
    docs = documents(rows)
    found = mixing.mixed_documents(docs).collect()
    taken = {(r["doc_id"], r["lang"]): 0 for r in found}
    for r in found:
        taken[r["doc_id"], r["lang"]] += 1
    plan = {}
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"] // r["size"]
    for doc_id in (1, 2):
        assert sum(n for (i, _), n in taken.items() if i == doc_id) == plan[doc_id]
    assert len([k for k in taken if k[0] == 1]) == min(3, plan[1])  # none stands in for another



def test_pipeline_stage_by_stage(spark):
    """Each stage's rows follow from those before it."""
    docs = common.table(spark, MIDDLE, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(common.stored(stage(spark, out[-1], MIDDLE), "test-stage"))
    assert all(df.columns == docs.columns for df in out[:-1])
    before, good, lined, single, mixed, pieces = out
    assert good.exceptAll(before).isEmpty() and 700 < good.count() < before.count()
    kept = [r["text"].split("\n") for r in lined.collect() if r["text"]]
    seen = Counter(line for text in kept for line in text if line.strip())
    assert max(seen.values()) == 1
    assert single.exceptAll(lined).isEmpty() and single.count() <= lined.count()
    assert mixed.select("doc_id").distinct().join(single, "doc_id", "left_anti").isEmpty()
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= mixing.MOST_REPEATS
    starts = pieces.filter("start = 0").groupBy("doc_id").count()
    assert starts.exceptAll(mixed.groupBy("doc_id").count()).isEmpty() and mixed.groupBy("doc_id").count().exceptAll(starts).isEmpty()


def test_pipeline_on_tables_without_rows(spark, documents, tmp_path):
    documents([], extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    common.table(spark, SMALL, "labels").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", ["op6_top_k", "op9_fingerprints"])
def test_query_equals_sql(spark, name):
    with connect(SMALL) as con:
        assert mismatch(contract.queries()[name](spark, SMALL), con, contract.oracle_sql()[name]) is None


def test_fingerprints_run_no_python(spark):
    plan = QUERIES["op9_fingerprints"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_stages_against_plain_python(spark, documents, tokens):
    """Each stage's rows on planted texts: scores, near lines, near copies, targets and packed pieces."""
    rng = random.Random(12)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(3, 8))) for _ in range(n))

    texts = ["\n".join(words(30) for _ in range(3)) for _ in range(24)]
    cut = texts[0].split("\n")[0].split(" ")
    texts.append(words(30) + "\n" + " ".join([*cut[:12], cut[12][::-1], *cut[13:]]))  # a line of the first text with one word changed
    base = words(120).split(" ")
    texts.append(" ".join(base))
    texts.append(" ".join([*base[:60], *words(3).split(" "), *base[63:]]))  # a near copy
    texts += ["buy now !!! ### $$$ " * 12, "### ### ###"]
    rows = [(i, t, "en", "hot" if i % 4 else "rare") for i, t in enumerate(texts)]
    docs = documents(rows, extra=False)

    good = corpus_pipeline.good_quality(spark, docs, SMALL)
    model = quality.fit(quality.features(docs), quality.training_labels(spark, SMALL))
    scores = model.score(quality.text_features(pa.array(texts)))
    assert {r["doc_id"] for r in good.collect()} == {i for i, s in enumerate(scores) if s >= quality.THRESHOLD}

    def edits(a, b):
        up = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(up[j] + 1, now[-1] + 1, up[j - 1] + (x != y)))
            up = now
        return up[-1]

    kept, wanted = [], {}
    for i, text in enumerate(texts):
        own = []
        for line in text.split("\n"):
            most = lambda other: max(2, min(len(line), len(other)) // 20)
            if not any(abs(len(line) - len(k)) <= most(k) and edits(line, k) <= most(k) for k in kept):
                own.append(line)
            kept.append(line)
        if own:
            wanted[i] = "\n".join(own)
    lined = corpus_pipeline.own_lines(spark, docs, SMALL)
    assert {r["doc_id"]: r["text"] for r in lined.collect()} == wanted and wanted[24] != texts[24]

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    sets, single = {i: shingles(t) for i, t in enumerate(texts)}, {}
    for i in sets:
        single[i] = next((j for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), i)
    alone = corpus_pipeline.one_of_each(spark, docs, SMALL)
    assert {r["doc_id"] for r in alone.collect()} == {i for i, j in single.items() if i == j} and single[26] == 25

    taken, sizes = Counter(), {"hot": [], "rare": []}
    for _, t, _, s in rows:
        sizes[s].append(len(t.split()))
    mixed = corpus_pipeline.mixed(spark, docs, SMALL)
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].split())
    for s, target in zip(("hot", "rare"), mixing.targets([sum(sizes["hot"]), sum(sizes["rare"])], [1, 2])):
        passes, sums = int(target // sum(sizes[s])), {0}
        for n in sizes[s]:
            sums |= {n + old for old in sums}
        assert abs(taken[s] - target) == pytest.approx(min(abs(passes * sum(sizes[s]) + n - target) for n in sums), abs=1)

    pieces = corpus_pipeline.packed(spark, docs, SMALL).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(range(len(texts)))
    for i, text in enumerate(texts):
        own = sorted((r["start"], r["length"]) for r in pieces if r["doc_id"] == i)
        assert [start for start, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) - len(tokens(text)) in (0, 1)  # an end mark may follow
