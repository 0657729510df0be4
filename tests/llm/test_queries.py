"""The numbered queries against SQL, brute force, a reference tokenizer, or held-out labels."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference, type_difference
from ontime_spark.llm import bpe, pii
from ontime_spark.llm.catalog import QUERIES, SQL, vocabulary


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    frame = QUERIES[name](spark, sf_dir)
    assert difference(frame, con, SQL[name]) is None
    assert type_difference(frame, con, SQL[name]) is None


def test_language_is_learnt(spark):
    rows = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = rows.join(lang, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95
    assert rows.filter("score < 0 or score > 1").isEmpty()


def test_ids_are_the_reference_tokenizers(spark, sf_dir, texts):
    entries = vocabulary()
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={})
    odd = ["", " \n\t x", "a▁b", "日本語🙂👍🏽 é", "<unk> <s>", "\x00\x01", "a" * 3000, "  \r\n  ", "١٢٣ half ½"]
    codec = bpe.Codec(entries, public_tokenizers.PATTERN)
    for text in odd:
        assert codec.encode(text) == known.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    for row in QUERIES["op4_byte_bpe"](spark, sf_dir).collect():
        ids = known.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_neighbours_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found = QUERIES["op5_projected_neighbours"](spark, sf_dir).collect()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (v * v[i]).sum(axis=1)
        score[i] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        own = [r for r in found if r["query_id"] == ids[i]]
        assert [r["rank"] for r in sorted(own, key=lambda r: (-r["score"], r["vec_id"]))] == list(range(1, 21))
        hits, total = hits + len(best & {r["vec_id"] for r in own}), total + 20
    assert hits >= 0.9 * total


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits or "0"),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def test_base_spans_against_plain_patterns(spark, sf_dir, texts):
    for row in QUERIES["op8_personal_data"](spark, sf_dir).collect():
        spans = plain_spans(texts[row["doc_id"]])
        counts = Counter(s.split(":")[0] for s in spans)
        assert [row[f"n_{k}"] for k in BASE] == [counts[k] for k in BASE]
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row["spans"].split(","))
    rng = np.random.default_rng(1)
    for _ in range(5000):
        text = "".join(rng.choice(list("a1@.+-( )29%b"), rng.integers(0, 50)))
        assert [f"{k}:{a}:{b}" for a, k, b in pii.base_spans(text)] == plain_spans(text)


def test_field_finds_other_forms():
    field = pii.train()
    for text, found in {
        "please call (366) 555-9807 now": [(12, "phone", 26)],
        "card 4222.2222.2222.2220 ok": [(5, "card", 24)],
        "version 2.10.3 of 62. items in 2024": [],
        "": [],
    }.items():
        assert pii.field_spans([text], field) == [found]


def test_toxicity_is_learnt(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op9_toxicity"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r["predicted"] for r in rows if r["toxic"]], [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) > 0.7 * len(toxic)
    assert sum(clean) < 0.05 * len(clean)


def test_articles_are_extracted(spark, sf_dir):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in QUERIES["op10_template_extraction"](spark, sf_dir).collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[row["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert row["text"] == "\n".join(p for p in parts if p)
        assert row["n_chars"] == len(row["text"])


def test_pipeline_against_its_parts(spark, sf_dir, texts):
    """Every document that comes out is a near copies' representative, without base personal data, encoded exactly."""
    entries = vocabulary()
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r["doc_id"] for r in rows} <= set(texts)
    for r in rows:
        text = b"".join(entries[i] for i in r["ids"]).decode()
        assert hashlib.sha256(text.encode()).hexdigest() == r["decoded_sha256"]
        assert plain_spans(text) == []
        if not re.search("[0-9@]", texts[r["doc_id"]]):
            assert text == texts[r["doc_id"]]
