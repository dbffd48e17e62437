import numpy as np
import pyarrow as pa

from fieldloom.llm import pseudo, queries


def test_gradient_and_probabilities():
    rng = np.random.default_rng(0)
    net = pseudo.Network(rng.integers(1, 50, pseudo.SIZE).astype(float))
    for n in net.NAMES:
        setattr(net, n, getattr(net, n).astype(np.float64))
    x, starts = rng.integers(0, pseudo.SIZE, 40).astype(np.int32), np.array([0, 15, 15, 16, 40])
    around = pseudo.contexts(x, starts)
    every = np.exp([net.step(np.full(40, t, np.int32), around) for t in range(pseudo.SIZE)])
    assert np.allclose(every.sum(axis=0), 1)  # each token's probabilities sum to 1
    slopes = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    net.step(x, around, slopes)
    for n in net.NAMES:
        flat, slope = getattr(net, n).reshape(-1), slopes[n].reshape(-1)
        for i in np.argsort(-np.abs(slope))[:3]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = -net.step(x, around).sum()
            flat[i] = old - 1e-5
            down = -net.step(x, around).sum()
            flat[i] = old
            assert abs((up - down) / 2e-5 - slope[i]) < 1e-3 * (1 + abs(slope[i])), n


def test_contexts_see_both_sides_and_not_the_token():
    x, starts = np.arange(7, dtype=np.int32), np.array([0, 3, 3, 7])
    e = pseudo.SIZE
    assert pseudo.contexts(x, starts).tolist() == [[e, e, 0, e, e, 3, 4], [e, 0, 1, e, 3, 4, 5], [1, 2, e, 4, 5, 6, e], [2, e, e, 5, 6, e, e]]


def test_held_out_order_matters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    held = docs.where("doc_id % 5 = 0").select("doc_id", "text").toPandas()
    rng = np.random.default_rng(4)
    held["mixed"] = [" ".join(rng.permutation(t.split())) for t in held.text]
    train = docs.where("doc_id % 5 != 0")
    words, counts = pseudo.vocabulary(train)
    net, start = pseudo.Network().load(pseudo.fit(train, words, counts)), pseudo.Network(counts)
    known = pa.array(words)
    score = lambda n, c: n.score(*pseudo._tokens(pa.array(held[c]), known)).sum()
    assert score(net, "text") > score(start, "text")
    got = pseudo.score(spark.createDataFrame(held[["doc_id", "text"]]), trained_on=train).toPandas()
    assert abs(got.log_prob.sum() - score(net, "text")) < 1e-3 * abs(score(net, "text")) + 50


def test_vocabulary_counts_all_documents(spark):
    docs = spark.createDataFrame([("The the, THE cat.",), ("cat dog",), (None,)], "text string")
    words, counts = pseudo.vocabulary(docs)
    assert words == ["the", "cat", "dog"] and counts.sum() == 6 and counts[:3].tolist() == [3, 2, 1]


def test_edges(spark):
    rows = [(1, None, 3), (1, None, 3), (2, "", 3), (None, "a b", 3), (3, "word " * 300_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_prob int")
    got = pseudo.score(docs).collect()
    assert len(got) == 5 and [r.n_tokens for r in got] == [0, 0, 0, 2, 300_000] and got[0].log_prob == 0 and got[0].mean_log_prob is None and got[3].log_prob < 0
    assert pseudo.score(docs.limit(0)).count() == 0


def test_words_of_a_bucket_differ_by_their_counts(spark):
    common = " ".join(f"k{i:04d}" for i in range(pseudo.KNOWN))
    rows = [(i, common) for i in range(4)] + [(10, "zzqa"), (11, "zzya"), (12, "zzqa zzqa"), (None, None), (13, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pseudo.word_score(docs).collect()}
    assert len(got) == 9 and abs(got[10].log_prob - got[11].log_prob - np.log(3)) < 1e-6 and got[12].n_tokens == 2
    assert got[None].n_tokens == got[13].n_tokens == 0 and got[13].log_prob == 0 and got[13].mean_log_prob is None
    net = {r.doc_id: r for r in pseudo.score(docs).collect()}
    assert abs(got[0].log_prob - net[0].log_prob) < 0.1 and abs(got[10].log_prob - net[10].log_prob - np.log(3 / 7)) < 0.1  # 4 tokens, 2 words, and 1
    held = spark.createDataFrame([(1, "zzya"), (2, "zzua"), (3, "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzua")], "doc_id long, text string")
    new = {r.doc_id: r.log_prob for r in pseudo.word_score(held, trained_on=docs).collect()}
    assert new[1] > new[2] > new[3]
    assert pseudo.word_score(docs.limit(0)).count() == 0


def test_query_tells_rare_words_apart(spark, tmp_path):
    common = " ".join(f"k{i:04d}" for i in range(pseudo.KNOWN))
    rows = [(i, common) for i in range(4)] + [(10, "zzqa"), (11, "zzya"), (12, "zzqa zzqa")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.log_prob for r in queries.op9_pseudo_likelihood(spark, str(tmp_path)).collect()}
    assert got[10] > got[11] + 1


def brute_score(flat, counts, tokens):
    """The network written out for one text, token by token."""
    net = pseudo.Network(counts).load(flat)
    out = 0.0
    for i, x in enumerate(tokens):
        around = [tokens[i + o] if 0 <= i + o < len(tokens) else pseudo.SIZE for o in range(-pseudo.SIDE, pseudo.SIDE + 1) if o]
        hidden = np.tanh(net.middle + sum(table[a] for table, a in zip(net.around, around)))
        for weights, bias, at in ((net.classes, net.class_bias, x // pseudo.MEMBERS), (net.words[x // pseudo.MEMBERS], net.word_bias[x // pseudo.MEMBERS], x % pseudo.MEMBERS)):
            z = (hidden @ weights + bias).astype(float)
            out += z[at] - np.log(np.exp(z - z.max()).sum()) - z.max()
    return out


def test_scores_by_brute_force_and_under_any_deal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (900, None)], "doc_id long, text string"))
    got = {}
    for n in (2, 6):
        words, counts = pseudo.vocabulary(docs.repartition(n))
        got[n] = pseudo.fit(docs.repartition(n), words, counts, part=3000)
        assert np.array_equal(got[n], pseudo.fit(docs.repartition(n, "text"), words, counts, part=3000))
    assert np.array_equal(got[2], got[6])  # one network, however the rows lie
    few = docs.where("doc_id < 12")
    scored = [{r.doc_id: r.log_prob for r in pseudo.score(few.repartition(n), trained_on=docs).collect()} for n in (1, 5)]
    flat = pseudo.fit(docs, words, counts)
    for r in few.collect():
        x, _ = pseudo._tokens(pa.array([r.text]), pa.array(words))
        want = brute_score(flat, counts, x.tolist())
        assert all(abs(s[r.doc_id] - want) < 1e-4 * (1 + abs(want)) for s in scored)
