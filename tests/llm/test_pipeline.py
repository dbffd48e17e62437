import hashlib
import struct

import corpus_pipeline as p
import public_tokenizers
from tokenizers import Tokenizer

from fieldloom.llm import toxicity

from .test_decontaminate import brute as contaminated
from .test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, steps = docs.columns, dict(p.STAGES)
    fitted = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, fitted).where("rejected").collect()}
    one = steps["toxicity"](spark, docs, SF)
    texts = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == columns and bad and texts.keys() == {r.doc_id for r in docs.select("doc_id").collect()} - bad
    two = steps["near_dedup"](spark, one, SF)
    stay = set(brute_components([(i, brute_print(t)) for i, t in texts.items()]).values())
    assert two.columns == columns and {r.doc_id for r in two.collect()} == stay
    three = steps["decontaminate"](spark, two, SF)
    clean = {r[0] for r in contaminated([(i, texts[i]) for i in stay], items) if not r[4]}
    assert three.columns == columns and {r.doc_id for r in three.collect()} == clean
    four = steps["pii"](spark, three, SF)
    after = {r.doc_id: r.text for r in four.collect()}
    assert four.columns == columns and after.keys() == clean and any(after[i] != texts[i] for i in clean)
    five = {r.doc_id: r for r in steps["bpe"](spark, four, SF).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert five.keys() == clean
    for i, text in after.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert five[i].n_tokens == len(ids) and five[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert five[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert {r.doc_id: r for r in p.run(spark, SF).collect()} == five


def test_stages_on_odd_rows(spark, tmp_path):
    extra = "stay fp component_id rows_of_it n_words spans items ids decoded rejected p_toxic features labelled_id t fold list_key found new n_entities entity kind".split()
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e", "en", "s", 9), (None, "a b c d e", "en", "s", 9), (3, "x " * 200_000, "en", None, 1), (4, "same words here now", "en", "s", 2), (4, "same words here now", "en", "s", 2), (5, "Mail a.b@c.example.com", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *(f"'e' as {c}" for c in extra))
    for data in (docs, docs.limit(0)):
        kept = data
        for name, stage in p.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns, name
            path = f"{tmp_path}/{name}-{data is docs}"
            kept.write.parquet(path)
            kept = spark.read.parquet(path)
        ids = sorted(str(r.doc_id) for r in kept.collect())
        done = p.STAGES[-1][1](spark, kept, SF)
        assert done.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and done.count() == len(ids)
        if data is docs:
            assert ids == ["1", "3", "4", "5", "None"]  # of two copies without an id one stays
            assert "a.b@c.example.com" not in {r.text for r in kept.collect()}
