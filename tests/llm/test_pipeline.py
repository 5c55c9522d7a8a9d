import hashlib

import corpus_pipeline
from threadloom.llm.common import table
from threadloom.llm.queries import vocabulary_path
from threadloom.session import materialize

from llm.test_near_leaks import brute_groups
from llm.test_pages_secrets import base_spans

SF = "/root/testdata/sf0.01"


def brute_mask(text):
    out, at = "", 0
    for start, _, end in base_spans(text):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_stages_equal_brute_force(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    docs = table(spark, SF, "documents")
    left = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        got = docs.collect()
        if name == "language":  # all are prose in known languages
            assert sorted(got) == sorted(left)
        elif name == "near_dedup":
            stay = {g[0] for g in brute_groups([(r["doc_id"], r["text"]) for r in left], 5) if g[3]}
            assert sorted(got) == sorted(r for r in left if r["doc_id"] in stay) and len(got) < len(left)
        elif name == "decontamination":
            kept = {r["doc_id"] for r in got}
            leaked = [r for r in left if any(t in r["text"] for t in items)]
            assert leaked and not kept & {r["doc_id"] for r in leaked}
            assert len(left) - len(got) - len(leaked) <= 2
        elif name == "secrets":
            masked = {r["doc_id"]: brute_mask(r["text"]) for r in left}
            assert {r["doc_id"]: r["text"] for r in got} == masked
            assert all(r["n_chars"] == len(r["text"]) for r in got) and any("[secret]" in t for t in masked.values())
        else:
            assert len(got) == len(left)
            texts = {r["doc_id"]: r["text"] for r in left}
            for r in got:
                ids = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
                assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
                assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        if name != "pieces":
            assert docs.columns == table(spark, SF, "documents").columns
        left = got


def test_edge_rows_pass_through(spark, rows, tmp_path):
    long = "the thing and the other of them " * 4000
    data = [
        (1, None, None, "s", None, 1.0), (2, "", "en", "s", 0, 1.0), (3, "the cat token=abcdef and the hat", "en", "s", 32, 1.0),
        (3, "the cat token=abcdef and the hat", "en", "s", 32, 1.0), (4, long, "en", None, len(long), None), (5, long + "x", "en", "s", 1, 1.0),
        (None, "the thing is here for them", "en", "s", 5, 1.0), (6, "der die das und nicht mit den", "de", "s", 5, 1.0),
    ]
    docs = rows(data, "doc_id long, text string, lang string, source string, n_chars long, score double")
    rows([(1, "one two three four five six seven")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if r["doc_id"] is not None)
    assert [g[0] for g in got] == [3, 4, 6]
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        nothing = materialize(stage(spark, nothing, str(tmp_path)), name)
        assert nothing.count() == 0
