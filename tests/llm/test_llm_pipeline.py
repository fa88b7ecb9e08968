"""The pipeline stage by stage, and the registered queries' columns."""

import re

import pytest

import corpus_pipeline
import llm_brute as brute
from plumbline.llm import quality
from plumbline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SECRET = re.compile(r'(?<![\w-])(?=[A-Za-z_-]*[0-9])[0-9a-f]{18,}(?![\w-])|AKIA[A-Z0-9]{16}')


def brute_quality(spark, docs):
    voted = quality.with_votes(quality.text_facts(spark.createDataFrame(docs, "doc_id long, text string")))
    names = [f"vote_{k}" for k in range(len(quality.RULES))]
    votes = {r.doc_id: tuple(r[n] for n in names) for r in voted.collect()}
    facts = {i: brute.facts(t) for i, t in docs}
    long = [votes[i] for i, _ in docs if facts[i]["n_words"] >= 50]
    good = dict(zip(votes, brute.posterior(list(votes.values()), *brute.em(long, 200, 0.8, quality.START, quality.START_WEIGHT))))
    return [
        (i, t) for i, t in docs
        if facts[i]["n_words"] >= 50 and 2 * facts[i]["n_repeat_words"] <= facts[i]["n_words"] and good[i] >= 0.5
    ]


def brute_lines(docs):
    near, same = brute.dropped_lines(docs), brute.dropped_lines(docs, min_words=1, edits=0)
    gone = {i: {*near[i], *same[i]} for i, _ in docs}
    return [
        (i, "\n".join(line for n, line in enumerate((t or "").split("\n")) if n not in gone[i])) for i, t in docs
    ]


def brute_simhash(docs):
    prints = [(i, brute.fingerprint(t, 4)) for i, t in docs]
    least = brute.simhash_classes(prints, 4)
    return [(i, t) for (i, t), (_, f) in zip(docs, prints) if least[i, f] == i]


def brute_redact(docs):
    out = []
    for i, text in docs:
        spans = [(int(s), int(e), k.upper()) for k, s, e in (x.split(":") for x in brute.base_spans(text).split(",") if x)]
        spans += [
            (m.start(), m.end(), "SECRET") for m in SECRET.finditer(text)
            if not any(s < m.end() and m.start() < e for s, e, _ in spans)
        ]
        clean, at = "", 0
        for s, e, kind in sorted(spans):
            if s >= at:
                clean += text[at:s] + f"[{kind}]"
            at = max(at, e)
        out.append((i, clean + text[at:]))
    return out


def test_stages_against_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    steps = (lambda d: brute_quality(spark, d), brute_lines, brute_simhash, brute_redact)
    assert len(corpus_pipeline.STAGES) == 5
    for (_, stage), step in zip(corpus_pipeline.STAGES, steps):
        found = stage(spark, frame, SF)
        assert found.dtypes == frame.dtypes
        docs = step(docs)
        rows = found.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(docs)
        if step in (brute_lines, brute_redact):
            assert all(r.n_chars == len(r.text) for r in rows)
        frame = spark.createDataFrame(rows, frame.schema)
    tok = brute.tokenizer("word_bpe_49k.json")
    want = sorted((i, *p) for i, t in docs for p in brute.pieces(tok, t))
    for rows in (corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect(), corpus_pipeline.run(spark, SF).collect()):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        assert len({r.sequence_id for r in rows}) == brute.best_fit([r.length for r in rows], 4096)


COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_quality": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
        "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op3_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4_bpe_codec": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_exact_dedup": {
        "doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string",
    },
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op7_personal_data": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
    "op8_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "dropped": "string"},
    "op9_best_fit_packing": {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op10_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    source = "pages" if "page_id" in kinds else "documents"
    key = "page_id" if "page_id" in kinds else "doc_id"
    ids = {r[key] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()}
    assert {r[key] for r in df.select(key).collect()} == ids


NATIVE = ("op2_quality", "op5_exact_dedup", "op7_personal_data", "op8_line_dedup")


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_personal_data_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op7_personal_data"](spark, SF).collect():
        base = brute.base_spans(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(base)
        assert set(base.split(",")) <= set(r.spans.split(",")) | {""}
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in ("email", "ip", "card", "phone"))


def test_a_stage_drops_the_tables_of_the_one_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.quality_rules(spark, docs, SF)
    paths = list(corpus_pipeline._left)
    written = spark.createDataFrame(first.collect(), docs.schema)
    assert paths and all(spark.read.parquet(p).count() for p in paths)
    corpus_pipeline.redaction(spark, first, SF).count()  # what is still read stays
    assert set(paths) <= set(corpus_pipeline._left)
    corpus_pipeline.redaction(spark, written, SF).count()
    assert not set(paths) & set(corpus_pipeline._left)
