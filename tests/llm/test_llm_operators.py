"""The text operators on small tables against brute force, and on odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from plumbline.llm import bpe, counts, exact, html, lines, packing, pii, quality, simhash, urls
from plumbline.llm.components import components

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 3000
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "one"), (7, "x" * 60_000), (8, LONG),
    (9, LONG), (5, "é😀 日本 <|endoftext|> a@b.co +1 (743) 555-3824"), (6, "1 " * 500), (10, "A\nb  c\r\nd"),
]
CLASHES = ("row", "text_", "fp", "sha", "n_words", "kept", "spans", "dropped", "tie", "length", "verdict", "fingerprint")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("other") for c in CLASHES})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty_of(df):
    return df.filter("false")


OPERATORS = {
    "simhash": simhash.near_duplicates,
    "quality": quality.quality,
    "encode": bpe.encode_documents,
    "counts": counts.prefix_counts,
    "budget": lambda df: counts.token_budget(df, 512),
    "exact": exact.exact_dedup,
    "pii": pii.personal_data,
    "lines": lines.line_report,
    "pack": packing.pack,
    "filter_quality": quality.filter_quality,
    "dedup_lines": lines.dedup_lines,
    "drop_near": simhash.drop_near_duplicates,
    "redact": pii.redact,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](empty_of(odd)).count() == 0


# ---- SimHash ----


def test_simhash_odd_rows(odd):
    got = sorted(tuple(r) for r in simhash.near_duplicates(odd).collect() if r.doc_id is not None)
    prints = [(i, brute.fingerprint(t, 4)) for i, t in ODD if i is not None]
    want = brute.simhash_classes(prints, 4)
    assert got == sorted((i, f"{f:016x}", want[i, f]) for i, f in prints)


def test_simhash_documents(docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [(r.doc_id, brute.fingerprint(r.text, 4)) for r in docs.collect()]
    want = brute.simhash_classes(prints, 4)
    assert got == {i: (f"{f:016x}", want[i, f]) for i, f in prints}


def test_simhash_keeps_one_of_each_class(odd):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    prints = [(i, brute.fingerprint(t, 4)) for i, t in ODD if i is not None]
    assert kept.count() == len(set(brute.simhash_classes(prints, 4).values()))


def clusters(rng, n):
    centres = rng.integers(-(1 << 62), 1 << 62, size=6)
    values = set()
    for _ in range(n):
        v = int(rng.choice(centres)) & (1 << 64) - 1
        for b in rng.choice(64, size=rng.integers(0, 6), replace=False):
            v ^= 1 << int(b)
        values.add(v - (1 << 64) if v >> 63 else v)
    return np.array(sorted(values), np.int64)


def n_groups(n, links):
    group = list(range(n))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        group[find(int(a))] = find(int(b))
    return sum(find(x) == x for x in range(n))


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_bit_sliced_kernels(radius):
    rng = np.random.default_rng(radius)
    for n in (2, 40, 500):
        v = clusters(rng, n)
        near = [
            (i, j) for i in range(len(v)) for j in range(i)
            if (int(v[i] ^ v[j]) & (1 << 64) - 1).bit_count() <= radius
        ]
        want = n_groups(len(v), near)
        for got in (simhash.links_in_buckets(v, np.array([len(v)]), radius), simhash.links_by_search(v, radius)):
            pairs = [] if got is None else list(zip(*got))
            assert n_groups(len(v), pairs) == want


@pytest.mark.parametrize("radius, count", [(0, 5), (4, 5), (4, 10**8), (4, 10**12), (64, 5)])
def test_masks_catch_every_pair(radius, count):
    rng = random.Random(1)
    masks = [m & (1 << 64) - 1 for m in simhash.band_masks(radius, count)]
    for _ in range(300):
        bits = rng.sample(range(64), min(radius, 64))
        flip = sum(1 << b for b in bits)
        assert any(flip & m == 0 for m in masks)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 60)
    monkeypatch.setattr(simhash, "SMALL", 30)
    v = clusters(np.random.default_rng(5), 900)
    fps = spark.createDataFrame([(int(x),) for x in v], "fp long")
    at = {int(x): k for k, x in enumerate(v)}
    links = [(at[r.a], at[r.b]) for r in simhash.near_links(fps, 4).collect()]
    near = [
        (i, j) for i in range(len(v)) for j in range(i)
        if (int(v[i] ^ v[j]) & (1 << 64) - 1).bit_count() <= 4
    ]
    assert n_groups(len(v), links) == n_groups(len(v), near)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 0 for k in range(301)} | {900: 900, 901: 900}


# ---- quality ----


def test_quality_counts(docs, odd):
    for df in (docs, odd):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        names = list(brute.facts(""))
        got = sorted(repr((r.doc_id, *[r[n] for n in names])) for r in quality.quality(df).collect())
        assert got == sorted(repr((i, *brute.facts(t).values())) for i, t in texts)


def test_quality_verdict_is_that_of_em(docs):
    voted = quality.with_votes(quality.text_facts(docs.select("doc_id", "text")))
    names = [f"vote_{k}" for k in range(len(quality.RULES))]
    rows = voted.collect()
    votes = {r.doc_id: tuple(r[n] for n in names) for r in rows}
    long = {r.doc_id: r.n_words >= 50 for r in rows}
    fit = brute.em([v for i, v in votes.items() if long[i]], 200, 0.8, quality.START, quality.START_WEIGHT)
    good = dict(zip(votes, brute.posterior(list(votes.values()), *fit)))
    for r in quality.quality(docs).collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and good[r.doc_id] >= 0.5)


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality(docs).join(labels, "doc_id").collect()
    assert not [r.doc_id for r in rows if r.kept and not r.quality]
    assert not [r.doc_id for r in rows if r.quality and not r.kept and not r.base_failed]


def test_quality_filter_keeps_rows_whole(odd, docs):
    assert quality.filter_quality(odd).columns == odd.columns
    kept = {r.doc_id for r in quality.quality(docs).filter("kept").collect()}
    got = quality.filter_quality(docs)
    assert got.schema == docs.schema and {r.doc_id for r in got.collect()} == kept


# ---- URL filter ----


def test_url_filter_odd(spark):
    urls_in = [
        None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "http://example.com", "http://com/",
        "https://www.example.com/en/", "ftp://a.b.net/es/x?y#z", "http://net/es/", "http://xnet/es/",
        "http://a.net:80/es/", "http://best-casino.org/x", "http://casinoa.org/", "http://a.org/CASINO?q",
        "http://a.org?casino", "x://y://z.com/", "http://a.net/fr/" + "q" * 5000,
    ]
    df = spark.createDataFrame([(k, u, "v") for k, u in enumerate(urls_in)], "page_id long, url string, host string")
    got = {r.page_id: r.url_filter for r in urls.filter_urls(df).collect()}
    said = {u: (got[k].host, got[k].path, got[k].rule, got[k].verdict) for k, u in enumerate(urls_in)}
    assert said[None] == said[""] == said["no scheme"] == ("", "", None, "allow")
    assert said["http://EXAMPLE.com/en/x"] == ("example.com", "/en/x", "example.com/en/", "block")
    assert said["http://example.com"] == ("example.com", "", None, "allow")
    assert said["http://com/"][2:] == ("com/", "allow")
    assert said["https://www.example.com/en/"][2:] == ("www.example.com/en/", "allow")
    assert said["ftp://a.b.net/es/x?y#z"] == ("a.b.net", "/es/x", "net/es/", "block")
    assert said["http://net/es/"][2:] == ("net/es/", "block")
    assert said["http://xnet/es/"][2:] == (None, "allow") == said["http://a.net:80/es/"][2:]
    assert said["http://best-casino.org/x"][2:] == (None, "block") == said["http://a.org/CASINO?q"][2:]
    assert said["http://casinoa.org/"][3] == "allow" == said["http://a.org?casino"][3]
    assert said["x://y://z.com/"][:2] == ("y:", "//z.com/")
    assert urls.filter_urls(empty_of(df)).count() == 0


def test_rules_wait_under_their_rarest_token(spark):
    df = spark.createDataFrame([("net", "/es/1")] * 3 + [("net", "/fr/1")], "host string, path string")
    df = df.withColumn("tokens", urls._url_tokens(F.col("host"), F.col("path")))
    table = {r[1]: r[0] for r in urls.indexed_rules(df, urls.SITE_RULES)}
    assert table["net/es/"] == "es" and table["net/fr/"] == "fr" and table["com/"] == "com"


# ---- BPE ----


@pytest.fixture(scope="module")
def bytes_bpe():
    return bpe.load(bpe.default_path())


@pytest.fixture(scope="module")
def library():
    return brute.tokenizer("byte_bpe_50k.json")


BITS = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "!", "é", "1", "　", "<|endoftext|>", "<|end", "ing",
        "\x85", "日本", "aaaa", "....", "--", "'ll", "😀"]


def random_texts(n, size, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_encoder_equals_the_library(bytes_bpe, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 64)
    encoder = bpe.Encoder(bytes_bpe)
    rng = random.Random(4)
    runs = ["".join(rng.choice(k) for _ in range(3000)) for k in ("a", "ab", "etaoinsh", "!?'", " ", " \n", "01", "é日")]
    for text in [*random_texts(1500, 60), *runs, *[r + "x" for r in runs], *[t or "" for _, t in ODD]]:
        cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 4)))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        got = [int(i) for ids in encoder.encode(parts) for i in ids]
        assert got == library.encode(text, add_special_tokens=False).ids, text[:50]


def test_lookahead_is_sufficient(bytes_bpe):
    """Tokens that end that many bytes before the cut do not depend on what follows."""
    rng = random.Random(6)
    for _ in range(60):
        letters = rng.choice(["ab", "etaoinsh", "0", "=-", "thin", "re"])
        head = "".join(rng.choice(letters) for _ in range(bytes_bpe.lookahead + 200)).encode()
        ends = []
        for _ in range(4):
            tail = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))).encode()
            at, own = 0, []
            for t in bytes_bpe.merge(head + tail):
                at += len(bytes_bpe.token_bytes[t])
                if at <= len(head) - bytes_bpe.lookahead:
                    own.append(t)
            ends.append(own)
        assert all(e == ends[0] and e for e in ends)


def test_stream_memory_is_bounded(bytes_bpe, library):
    stream, out, most = bpe.PieceStream(bytes_bpe), [], 0
    for _ in range(300):
        out += stream.feed(b"abcab" * 40)
        most = max(most, len(stream.pending))
    out += stream.finish()
    assert most <= 7 * bytes_bpe.lookahead
    assert out == library.encode("abcab" * 40 * 300, add_special_tokens=False).ids


def test_decoder_state(bytes_bpe, library):
    ids = library.encode("é😀日本 x", add_special_tokens=False).ids
    for cut in range(len(ids) + 1):
        d = bpe.Decoder(bytes_bpe)
        assert d.feed(ids[:cut]) + d.feed(ids[cut:]) + d.finish() == "é😀日本 x"
        d = bpe.Decoder(bytes_bpe)
        assert d.feed(ids[:cut]) + d.finish() == library.decode(ids[:cut], skip_special_tokens=False)


def test_codec_queries(spark, docs, odd, library):
    from plumbline.llm.queries import QUERIES

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op4_bpe_codec"](spark, SF).collect()}
    assert got == {r.doc_id: brute.codec(library, r.text) for r in docs.collect()}
    rows = bpe.decode_documents(bpe.encode_documents(odd)).collect()
    want = sorted(repr((i, t or "")) for i, t in ODD)
    assert sorted(repr((r.doc_id, r.text)) for r in rows) == want


# ---- prefix counts ----


def test_counts_of_every_prefix(bytes_bpe, library, monkeypatch):
    monkeypatch.setattr(counts, "BLOCK", 64)
    counter = counts.PrefixCounter(bytes_bpe)
    for text in [*random_texts(300, 40, 8), "", " ", "it're", "a <|endoftext|> b", "x" * 300]:
        cuts = library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)
        assert counter.counts(text).tolist() == [len(c.ids) for c in cuts], text


def test_budget_from_counts(spark, docs, odd, library):
    for df in (docs, odd):
        texts = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=repr)
        rows = sorted(counts.token_budget(df, 100).collect(), key=lambda r: repr((r.doc_id, r.n_bytes)))
        want = []
        for i, t in texts:
            n = len(library.encode(t, add_special_tokens=False).ids)
            want.append((i, len(t.encode()), n, n > 100))
        assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:4]) for r in rows)
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for r in counts.token_budget(docs, 100).limit(20).collect():
        fits = lambda k: len(library.encode(by_id[r.doc_id][:k], add_special_tokens=False).ids) <= 100  # noqa: B023,E731
        assert fits(r.fitting_chars)
        assert not any(fits(k) for k in range(r.fitting_chars + 1, min(len(by_id[r.doc_id]), r.fitting_chars + 40) + 1))


# ---- exact dedup ----


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("fan_in", [2, 4])
def test_exact_dedup(odd, keep, fan_in):
    rows = exact.exact_dedup(odd, keep=keep, fan_in=fan_in).collect()
    groups = {}
    for i, t in ODD:
        groups.setdefault(t or "", []).append(i)
    pick = min if keep == "min" else max
    assert len(rows) == len(ODD)
    for text, ids in groups.items():
        own = [r for r in rows if r.text_sha256 == brute.sha(text)]
        order = lambda i: -1 if i is None else i
        assert {r.keep_id for r in own} == {pick(ids, key=order)}
        assert {r.group_size for r in own} == {len(ids)} and sum(r.kept for r in own) == 1


# ---- personal data ----


def test_base_spans(docs, odd, spark):
    rng = random.Random(5)
    bits = list("0123456789") * 2 + list("aB.@-+ ()_%") + [
        "1.2.3.4", "256.", "a@b.c", "4111 1111 1111 1111", "+1 (743) 555-3824", "é", "😀", "\n", "00012.",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["1" * 20_000, "a." * 10_000 + "@", "+1(" * 9_000, "1 " * 9_000, "1." * 9_000, "a@" + "b." * 9_000 + "c"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for df in (made, docs, odd):
        want = sorted(repr((r.doc_id, brute.base_spans(r.text))) for r in df.collect())
        got = pii.personal_data(df).select("doc_id", pii.span_list(F.col("base")).alias("b")).collect()
        assert sorted(repr(tuple(r)) for r in got) == want


def test_added_spans_are_secrets_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import re

    pattern = re.compile(r'(?:password=|token = ")[0-9a-f]{18,}|AKIA[A-Z0-9]{16}')
    want = {r.doc_id: len(pattern.findall(r.text)) for r in docs.collect()}
    for r in pii.personal_data(docs).collect():
        assert len(r.spans) - len(r.base) == want[r.doc_id]


def test_long_keys_names_and_short_ibans_are_candidates(spark):
    key = "sk-proj-" + "aB3dE6gH9k" * 16
    slug = "a-b_" * 5000 + "c1"
    texts = [
        f"token = {key} end", "we met Maria Lopez there", "Frau Lopez, Anna.", "to NO93 8601 1117 947 now",
        "to NO9386011117947 now", slug, "Marias Annabel", "é" + "x" * 200_000 + "1",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(c.kind, c.m) for c in r.candidates] for r in pii.found_spans(df).collect()}
    assert got[0] == [("secret", key)] and got[1] == [("name", "Maria Lopez")]
    assert got[2] == [("name", "Frau Lopez"), ("name", "Anna")]
    assert got[3] == [("iban", "NO93 8601 1117 947")] and got[4] == [("iban", "NO9386011117947")]
    assert got[5] == [("secret", slug)] and got[6] == [] and got[7] == []
    pii.personal_data(df).collect()
    known = spark.createDataFrame([(i, f"token = {key}{i} end") for i in range(30)], "doc_id long, text string")
    assert {r.text for r in pii.redact(known).collect()} == {"token = [SECRET] end"}


def test_names_need_evidence(spark):
    texts = [
        "Max 5 items were sold. Jan 2024 was cold. Mark the box.", "We met Maria Lopez and Dr. Weber there.",
        "Frau Müller-Lüdenscheidt und Herr Schmidt", "Will it rain in May? April is over.", "Paul said so.",
        "We saw Thomas" + "o" * 40 + " and Anna Mei" + "e" * 40 + ".",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert [got[i] for i in range(5)] == [
        texts[0], "We met [NAME] and [NAME] there.", "[NAME] und [NAME]", texts[3], texts[4]
    ]
    assert got[5] == "We saw Thomas" + "o" * 40 + " and [NAME]."


def test_very_many_matches_in_one_text(spark):
    n = 6_000
    text = " ".join(f"é x{i}@a.b 10.0.0.1 maria" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.personal_data(df).first()
    assert brute.base_spans(text) == ",".join(f"{x.kind}:{x.s}:{x.e}" for x in row.base)
    assert pii.redact(df).first().text == " ".join("é [EMAIL] [IP] maria" for _ in range(n))


def test_candidates_apart_from_many_base_spans(spark):
    key = "aB3dE6gH9kaB3dE6gH9k"
    text = " ".join(f"{key}@a.b {key}{i}" for i in range(100))
    df = spark.createDataFrame([(1, text), (2, f"{key}@a.b {key}0")], "doc_id long, text string")
    found = {r.doc_id: [c.m for c in r.candidates] for r in pii.found_spans(df).collect()}
    assert found == {1: [f"{key}{i}" for i in range(100)], 2: [f"{key}0"]}


def test_redaction(spark, odd):
    df = spark.createDataFrame(
        [(1, "é x@y.de, 1.2.3.4 end", 9), (2, "a@1.2.3.4 z", 0), (3, None, 5), (4, "plain", 5)],
        "doc_id long, text string, n_chars int",
    )
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df).collect()}
    assert got[1] == ("é [EMAIL], [IP] end", 19) and got[2] == ("[EMAIL] z", 9)
    assert got[3] == ("", 0) and got[4] == ("plain", 5)
    assert pii.redact(odd).columns == odd.columns


# ---- lines ----


def test_line_report_small(spark):
    rng = random.Random(9)
    for trial in range(3):
        vocabulary = ["a", "b", "c", "d"]
        texts = []
        for i in range(60):
            rows = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(0, 4))]
            texts.append((i, "\n".join(rows)))
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
        for edits in (0, 1):
            got = {r.doc_id: list(r.dropped) for r in lines.line_report(df, max_edits=edits).collect()}
            assert got == brute.dropped_lines(texts, edits=edits), trial


def test_short_lines_go_when_exact(spark):
    rng = random.Random(4)
    texts = [(i, "\n".join(" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 8))) for _ in range(5))) for i in range(60)]
    texts.append((60, "Thnd stheed.\n\nThnd  stheed.\nThnd stheed\n"))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {r.doc_id: list(r.dropped) for r in lines.line_report(df, exact_words=1).collect()}
    near, same = brute.dropped_lines(texts), brute.dropped_lines(texts, min_words=1, edits=0)
    assert found == {i: sorted({*near[i], *same[i]}) for i, _ in texts}
    assert found[60] == [2] and near[60] == []
    kept = {r.doc_id: r.text for r in lines.dedup_lines(df, exact_words=1).collect()}
    assert kept[60] == "Thnd stheed.\n\nThnd stheed\n"


def test_very_long_lines(spark):
    rng = random.Random(8)
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 50)) for _ in range(3_000)]
    edits = [base[:at] + new + base[at + 1 :] for at, new in ((0, ["x"]), (1_500, []), (2_999, ["y", "z"]))]
    texts = [(0, " ".join(base)), *((i, " ".join(e)) for i, e in enumerate(edits, 1)), (9, "\x0ba\x0bb c d e\n" + "a b c d e\n" * 900)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    near, same = brute.dropped_lines(texts), brute.dropped_lines(texts, min_words=1, edits=0)
    found = {r.doc_id: list(r.dropped) for r in lines.line_report(df, exact_words=1).collect()}
    assert found == {i: sorted({*near[i], *same[i]}) for i, _ in texts} and found[3] == []
    kept = {r.doc_id: r.text for r in lines.dedup_lines(df, exact_words=1).collect()}
    assert kept[9] == "\x0ba\x0bb c d e\n" and kept[1] == kept[2] == ""


def test_running_results(spark):
    from plumbline.llm.common import running

    values = [list(range(n)) for n in (0, 1, 255, 256, 257, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>")
    got = [r[0] for r in df.select(running(F.col("v"), "long", lambda a, b: a + b)).collect()]
    assert got == [[sum(v[: i + 1]) for i in range(len(v))] for v in values]


def test_line_sql_cuts_words_at_every_space(spark, tmp_path):
    import duckdb

    from plumbline.llm.queries import ORACLES, QUERIES

    rows = [(1, "a b\x0bc\td\x0ce f", "en"), (2, "a b c d e f", "en"), (3, "x\ny\r z \nx", "en"), (4, None, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["op8_line_dedup"](spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "dropped")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(ORACLES["op8_line_dedup"]).fetchall())
    assert got.filter("n_dropped > 0").count() == 2


def test_line_dedup_odd(odd, spark):
    found = lines.line_report(odd).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert by_id[8].dropped == [] and by_id[9].dropped == [0]  # the same long line
    clean = lines.dedup_lines(odd)
    assert clean.columns == odd.columns and clean.count() == len(ODD)
    assert {r.doc_id: r.text for r in clean.collect()}[9] == ""
    twice = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d f\nx")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in lines.dedup_lines(twice).collect())
    assert got == [(1, "a b c d e"), (1, "a b c d e"), (2, "x")]  # repeated rows are one document


@pytest.mark.parametrize("a, b, near", [
    ("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "a c", True), ("a b c", "b c", True),
    ("a b c", "a b", True), ("a b c", "a x y", False), ("a b c", "c", False), ("a b", "b a", False), ("", "a", True),
])
def test_one_edit(spark, a, b, near):
    row = spark.createDataFrame([(a.split(), b.split())], "a array<string>, b array<string>")
    for x, y in (("a", "b"), ("b", "a")):
        assert row.select(lines.within_one_edit(F.col(x), F.col(y))).first()[0] is near


# ---- packing ----


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) == brute.best_fit([r.length for r in rows], capacity)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(docs, odd, capacity):
    tok = brute.tokenizer("word_bpe_49k.json")
    for df in (docs, odd):
        rows = packing.pack(df, capacity).collect()
        got = sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
        want = [(r.doc_id, *p) for r in df.collect() for p in brute.pieces(tok, r.text, capacity)]
        assert got == sorted(map(repr, want))
        check_packing(rows, capacity)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packed_sequences_hold_the_tokens(docs, odd, capacity):
    tok = brute.tokenizer("word_bpe_49k.json")
    for df in (docs, odd):
        texts, made = {}, {}
        for r in packing.pack(df, capacity).collect():
            own = np.frombuffer(r.tokens, "<u4").tolist()
            assert len(own) == r.length
            made.setdefault(r.sequence_id, []).append((r.offset, own))
            texts.setdefault(r.doc_id, []).append((r.start, own))
        for own in made.values():
            ids = [i for _, part in sorted(own) for i in part]
            assert len(ids) <= capacity and ids[-1] == 1 or len(ids) == capacity
        want = {}
        for r in df.collect():
            want.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
        assert {i: sorted(t for _, own in x for t in own) for i, x in texts.items()} == {
            i: sorted(t for own in x for t in own) for i, x in want.items()
        }
        for i, x in texts.items():
            if len(want[i]) == 1:
                assert [t for _, own in sorted(x) for t in own] == want[i][0]


def test_best_fit_plan():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.choice([10, 37, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 90))]
        counted = {n: sizes.count(n) for n in set(sizes)}
        assert packing.best_fit_decreasing(counted, capacity).sequences == brute.best_fit(sizes, capacity)
    plan = packing.best_fit_decreasing({n: 10**9 + n for n in range(1, 4097)}, 4096)
    assert len(plan.rank) < 20_000


def test_word_tokens_equal_the_library():
    tok, words = brute.tokenizer("word_bpe_49k.json"), packing.WordTokens(packing.default_path())
    for text in [*random_texts(800, 30, 12), "ΑΣ Σ", "İé <|startoftext|>x", "K ﬁ ǅ", LONG]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_plan_in_bands(docs, monkeypatch):
    whole = sorted(map(tuple, packing.pack(docs, 512).drop("tokens").collect()))
    monkeypatch.setattr(packing, "SENT_ROWS", 20)  # the plan goes in bands, the starts by join
    assert sorted(map(tuple, packing.pack(docs, 512).drop("tokens").collect())) == whole
    assert packing._bands(np.array([1, 1, 2, 5, 5, 5, 9]), 3) == [(1, 2), (5, 5), (9, 9)]


# ---- HTML ----


def test_held_out_pages():
    field = html.default_field()
    test = html.labelled_pages(150, seed=77)
    right = total = 0
    for blocks, labels in test:
        got = field.decode(blocks)
        right += sum(x == y for x, y in zip(got, labels))
        total += len(labels)
    assert right / total > 0.99


def test_viterbi_is_the_best_labelling():
    from itertools import product

    field = html.default_field()
    for blocks, _ in html.labelled_pages(30, seed=5):
        blocks = blocks[:9]
        scores = field.scores(html.features(blocks))

        def value(labels):
            total = sum(s for s, y in zip(scores, labels) if y)
            for a, b, x, y in zip(blocks, blocks[1:], labels, labels[1:]):  # noqa: B023
                total += field.steps[html._same_parent(a, b)][x][y]
            return total

        best = max(value(p) for p in product((0, 1), repeat=len(blocks)))
        assert abs(value(field.decode(blocks)) - best) < 1e-9


def test_blocks():
    page = (
        "<title>t</title><script>var a='</p><p>x'</script><p>a &amp; b&copy;&nbsp;c\n d<p><b>e<br>f<p>g</p>"
        "<ul><li>h<li>i</ul><!-- <p>no</p> --><td>j</td>&am <a href"
    )
    assert [b.text for b in html.leaf_blocks(page)] == ["a & b© c d", "e f", "g", "h", "i", "j", "&am"]
    assert html.leaf_blocks("") == []


def test_broken_markup_is_read_anyway():
    rng = random.Random(0)
    bits = [
        "<", "<![", ">", "<!", "--", "<!--", "-->", "<![CDATA[", "]]>", "<![x", "<?", "?>", "</", "p", "div", "a href='", '"', "'",
        "&", "&amp", "&#x", "&#0;", "&#99999999;", "&#xD800;", "<script>", "</script", "<style", "<title>", "<textarea>", "<br/",
        "<table><tr><td>", "</ul>", "<!DOCTYPE", "\x00", "é", " ",
    ]
    field = html.default_field()
    for _ in range(20_000):
        html.main_text("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))), field).encode()
    page = "<!--[if IE]><p>no</p><![endif]--><article><p>yes</p><![if x]><p>too</p><![endif]></article>"
    assert html.main_text(page, field) == "yes\ntoo"


#: Pages written by hand, whose classes say nothing, and their main text.
BY_HAND = [
    ("<html><head><title>x</title><p>One two three four.</p><p>Five six seven.</p>", "One two three four.\nFive six seven."),
    ("<html><head><meta charset=a>Loose words to begin with, and more.<p>Then a paragraph follows here.</p>",
     "Loose words to begin with, and more.\nThen a paragraph follows here."),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p><p>See <noscript>this</noscript> and "
     "<object>that</object>.</p></article>", "Let x=1 hold.\nSee this and that."),
    ("<body><div><a href=1>Home</a> <a href=2>News</a></div><p>The council met on Tuesday to discuss the bridge.</p>"
     "<p>It will be closed for repairs until the end of the year.</p><ul><li><a href=3>Imprint</a></li><li><a href=4>"
     "Contact</a></li></ul><div>&copy; 2020 Example Press</div></body>",
     "The council met on Tuesday to discuss the bridge.\nIt will be closed for repairs until the end of the year."),
    ("<table><tr><td><a href=1>Home</a></td><td><a href=2>Shop</a></td></tr></table><div class=q7><h1>On bread</h1><p>Bread "
     "needs flour, water, salt and a long night of rest.</p></div><form><label>Name</label><input></form>",
     "On bread\nBread needs flour, water, salt and a long night of rest."),
    ("<p>A text without any frame around it, as old pages have it.<p>And a second part of the same.",
     "A text without any frame around it, as old pages have it.\nAnd a second part of the same."),
]


def test_pages_written_by_hand():
    field = html.default_field()
    assert [html.main_text(page, field) for page, _ in BY_HAND] == [text for _, text in BY_HAND]


def test_open_ends_of_pages():
    import time

    for page, want in (("a<!-- b", "a"), ("a<!-- b --> c", "a<!-- b --> c"), ("a<!-->b", "a"), ("a <b", "a "), ("a < b", "a < b"),
                       ("a<b>c</", "a<b>c"), ("a>b<!-- <i", "a>b"), ("", "")):
        assert html._finished(page) == want, page
    start = time.time()
    html.leaf_blocks("<a" * 100_000 + ">" + "<" * 100_000)
    assert time.time() - start < 10


def test_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")

    def want(h):
        body = re.search(r"<article>(.*?)(</article>|$)", h, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        return "\n".join(p for p in parts if p)

    rows = pages.collect()
    got = {r.page_id: r.main_text for r in html.extract(pages).collect()}
    assert got == {r.page_id: want(r.html) for r in rows}
    odd = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (2, "", "x"), (3, "<p>", "x"), (4, "plain < text", "x")],
        "page_id long, html string, row string",
    )
    found = html.extract(odd)
    assert found.columns == ["page_id", "row", "main_text"] and found.count() == 5
    assert {r.main_text for r in found.filter("page_id < 4").collect()} == {""}
    assert html.extract(empty_of(odd)).count() == 0


# ---- shared helpers ----


def test_join_groups_takes_hot_and_cold_keys(spark):
    from plumbline.llm.common import join_groups, stage

    rows = stage(spark.range(6000).selectExpr("if(id < 2500, 0, id) as k", "id"), "rows")
    groups = stage(rows.groupBy("k").agg(F.count("*").alias("size"), F.min("id").alias("least")), "groups")
    got = join_groups(rows, groups.filter("k != 5999"), ["k"], rows.count())
    assert got.count() == 5999 and got.filter("least = 0 and size = 2500").count() == 2500
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_scratch_tables_go(spark):
    from pathlib import Path

    from plumbline.llm.common import Scratch

    with Scratch(spark) as scratch:
        assert scratch.stage(spark.range(5), "x").count() == 5
        kept = [Path(p.removeprefix("file:")) for p in scratch.paths]
        assert all(p.exists() for p in kept)
    assert not any(p.exists() for p in kept)


def test_hot_text_and_line(spark):
    """A third of all rows share one text and one line."""
    texts = [(i, "the same line in very many documents" if i % 3 == 0 else f"line number {i} of its own here\nx") for i in range(3300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = exact.exact_dedup(df, keep="max").filter("group_size > 1")
    assert found.count() == 1100 and found.filter("kept").collect()[0].doc_id == 3297
    dropped = lines.line_report(df, max_edits=0).filter("size(dropped) > 0")
    assert dropped.count() == 1099 and dropped.filter("doc_id = 0").count() == 0
