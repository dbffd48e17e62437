import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCAB = bpe.vocabulary(open(PATH, encoding="utf-8").read())


def same(texts):
    ids, starts = VOCAB.encode(pa.array(texts, pa.string()))
    decoded = VOCAB.decode(ids, starts).to_pylist()
    for i, t in enumerate(texts):
        want = LIBRARY.encode(t or "", add_special_tokens=False).ids
        assert ids[starts[i] : starts[i + 1]].tolist() == want, repr(t)[:200]
        assert decoded[i] == LIBRARY.decode(want, skip_special_tokens=False)


def test_documents():
    same(pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist())


def test_odd_texts():
    same([None, "", " ", "\x1c a\x1cb c d\x85e", "it's we'LL I'm 'd 'sx", "<|startoftext|>Hi<|endoftext|><|endoftext|", "a<|endoftext|>'s<|ENDOFTEXT|>", "ΣΑΣ ΟΔΟΣ ς", "İstanbul ß ǅ ŉ", "é ́x ȩ́", "中文字符 123 ½²Ⅷ ١٢", "\U0001f468‍\U0001f469 ok\x00z", "x" * 3000, "-" * 999 + "a1b2", "ab" * 70_000])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcdeilnorstuy'ABĀéßñ \n.,!?-12"), st.characters(codec="utf-8")), max_size=60), max_size=8))
def test_random_texts(texts):
    same(texts)


def test_operator(spark):
    docs = spark.createDataFrame([(1, "Hello there", "x"), (1, None, "y"), (2, "", None)], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).orderBy("doc_id", "decoded").collect()
    assert [r.decoded for r in got] == ["", "hello</w> there</w>", ""] and got[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}
    assert bpe.encode(docs.limit(0), PATH, decoded="text").count() == 0
