"""The corpus operators against brute force, exact round trips and held-out labels; odd inputs of every kind."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from millrace.llm import decontaminate, licenses, lm, nbsvm, quality_rules, sentencepiece, simhash, token_files, toxicity, url_filter

DATA = "/root/testdata/sf0.001"
MODEL, BPE = "/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_50k.json"
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "word"), (4, "word"), (5, "Été \U0001f389 日本語 " * 50), (None, "x y"), (6, "a " * 30000), (7, " tab\tand\r\nline  two\n"), (8, "▁ <|endoftext|> \x00")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(k, t, "clash", 1) for k, t in ODD], "doc_id long, text string, score string, kept int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_quality_rules_base_by_brute_force(docs, odd):
    for frame in (docs, odd):
        texts = [(t or "") for (t,) in frame.select("text").collect()]
        got = sorted(tuple(r)[1:6] for r in quality_rules.judge(frame).collect())
        want = []
        for t in texts:
            w = t.encode().split()
            windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)] if len(w) < 2000 else []
            seen = {x for x in windows if windows.count(x) > 1} if len(set(windows)) < len(windows) else set()
            inside = {j for k, x in enumerate(windows) if x in seen for j in range(k, k + 8)}
            lines = [x for x in t.split("\n") if x.encode().split()]
            repeat = len(inside) if len(w) < 2000 else quality_rules.repeat_words(np.unique(w, return_inverse=True)[1])
            want.append((len(w), sum(len(x.decode()) for x in w), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), repeat))
        assert got == sorted(want)
    assert quality_rules.judge(odd.limit(0)).count() == 0


def test_simhash_by_brute_force(spark, docs, odd):
    for frame in (docs, odd):
        rows = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
        prints = []
        for _, t in rows:
            w = t.encode().lower().split()
            grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
            h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
            prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
        group = list(range(len(rows)))
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    a, b = group[i], group[j]
                    group = [b if g == a else g for g in group]
        smallest = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in set(group)}
        want = sorted((str(rows[k][0]), f"{prints[k]:016x}", str(smallest[group[k]])) for k in range(len(rows)))
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.components(frame).collect()) == want


def test_simhash_links_across_many_tiles_and_cut_tiles(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 300, dtype=np.uint64)
    values = [int(c) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for c in centres for _ in range(3)] + [int(c) for c in centres] + [k for k in range(200)]
    distinct = sorted({v for v in values})
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in distinct], "fp long")
    pairs = simhash.spread(simhash.links(frame, len(distinct), tile_rows=16, tile_max=32)).collect()
    got: dict[int, int] = {r.node: r.label for r in pairs}
    a = np.array(distinct, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    root = list(range(len(a)))
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = root[i], root[j]
        if x != y:
            root = [x if r == y else r for r in root]
    classes = {}
    for k, r in enumerate(root):
        classes.setdefault(r, set()).add(int(a[k].astype(np.int64)))
    want = {frozenset(c) for c in classes.values() if len(c) > 1}
    mine: dict[int, set[int]] = {}
    for node, label in got.items():
        mine.setdefault(label, set()).add(node)
    assert {frozenset(c) for c in mine.values()} == want


def test_lm_base_by_brute_force(docs, odd):
    for frame in (docs, odd):
        rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in frame.select("doc_id", "text").collect()]
        held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
        count: dict = {}
        for k, tokens in rows:
            for t in tokens if not held(k) else ():
                count[t] = count.get(t, 0) + 1
        n, v = sum(count.values()), len(count)
        want = sorted((str(k), held(k), len(ts), sum(t in count for t in ts), n, round(sum(np.log10((count.get(t, 0) + 1) / (n + v + 1)) for t in ts), 4)) for k, ts in rows)
        got = lm.score(frame, block_bytes=50_000).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    assert sum(r.score for r in lm.score(docs).collect()) > sum(r.base_score for r in lm.score(docs).collect())


def test_lm_is_a_distribution(spark):
    frame = spark.createDataFrame([(1, "a b a"), (3, "b")], "doc_id long, text string")
    one = lm.score(frame.unionByName(spark.createDataFrame([(None, "a b a")], "doc_id long, text string")), prior=1.0).collect()
    assert len({r.score for r in one if r.n_tokens == 4}) == 1


def test_decontamination_finds_edited_copies(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [[word() for _ in range(rng.randint(5, 60))] for _ in range(60)]
    texts, want = [], set()
    for k in range(300):
        body = [word() for _ in range(200)]
        if k % 2:
            item = k % len(items)
            copy = list(items[item])
            for _ in range(len(copy) // 12):
                copy[rng.randrange(len(copy))] = word()
            at = rng.randrange(200)
            body[at:at] = copy
            want.add((k, item))
        texts.append((k, " ".join(body)))
    found = decontaminate.matches(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(t).upper() + "!") for k, t in enumerate(items)], "item_id long, text string"), items=25)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_toxicity_and_quality_on_held_out_labels(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    for judge, label, floor in ((toxicity.judge, "toxic", 0.93), (nbsvm.judge, "quality", 0.95)):
        seen = judge(docs, labels).join(labels, "doc_id").filter("held_out").collect()
        assert sum(r.predicted == r[label] for r in seen) >= floor * len(seen)


def test_toxic_words_are_found_with_gaps_and_insertions():
    clean = [f"the {a}{b} and {b}{a} of it".encode() for a in ("thre", "onin", "lyre", "shen", "wher") for b in ("tion", "edor", "ble", "hean", "ands")] * 4
    bad = [t + b" you worthless thing" for t in clean[:40]]
    weights, bias, *_ = toxicity.fit(clean + bad, [0] * len(clean) + [1] * len(bad))
    got = toxicity.margins([b"worthless", b"w.o.r.t.h.l.e.s.s", b"worthxless", b"whereands"], weights, bias)
    assert min(got[:3]) > got[3]


def test_classifiers_without_labels_and_odd_inputs(odd, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in nbsvm.judge(odd, none).collect()} == {1} and {r.predicted for r in toxicity.judge(odd, none).collect()} == {0}
    assert toxicity.judge(odd, none).count() == nbsvm.judge(odd, none).count() == len(ODD)


def test_sentencepiece_round_trip_and_streaming(docs, odd):
    for frame in (docs, odd):
        assert all(r.round_trip for r in sentencepiece.encoded_and_checked(frame, MODEL).collect())
    codec = sentencepiece.Codec.load(MODEL)
    for t in ("hello, world", "  two  blanks ", "x" * 200, "naïve — “quoted” \U0001f389"):
        streamed = [i for part in codec.viterbi("▁" + t.replace(" ", "▁")) for i in part]
        assert np.frombuffer(codec.encode(t.encode()), "<u4").tolist() == streamed
        score = {i: s for i, s in codec.pieces.values()}
        text, best = "▁" + t.replace(" ", "▁"), [0.0]
        for e in range(1, len(text) + 1):
            fits = [best[s] + codec.pieces[text[s:e]][1] for s in range(max(0, e - codec.longest), e) if text[s:e] in codec.pieces]
            best.append(max(fits, default=best[e - 1] + codec.unknown * len(text[e - 1].encode())))
        if all(i in score for i in streamed):
            assert abs(sum(score[i] for i in streamed) - best[-1]) < 1e-6


def test_token_files_round_trip(spark, docs, odd, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    for name, frame in (("docs", docs), ("odd", odd)):
        folder = f"file://{tmp_path}/{name}"
        token_files.write_ids(frame, folder, token_files.tokenizer_encode(BPE), 2, bits=name == "odd")
        rows = sorted(((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        want, start = [], 0
        for k, t in rows:
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
            want.append((k, start, np.array(ids, "<u4").tobytes()))
            start += len(ids)
        got = token_files.read_ids(spark, folder, frame.schema["doc_id"].dataType).collect()
        assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in got), key=lambda r: r[1]) == want
    for ids in (np.arange(100_003, dtype=np.uint32), np.zeros(0, np.uint32)):
        for bits in (False, True):
            assert (token_files.from_planes(token_files.to_planes(ids, bits), len(ids)) == ids).all()


def test_license_bounds_lose_nothing(spark, odd):
    lines = ["Licensed under the Apache License, Version 2.0.", "LICENSED   under the apache licence version 2 0", "Released under the MIT License", "all rights reserved", "rights", "This work is licensed under the GNU General Public License, version 2."]
    frame = spark.createDataFrame([(k, f"some words here\n{x}\nmore") for k, x in enumerate(lines)], "doc_id long, text string")

    def dice(unit):
        best = (0.0, None)
        grams = set(licenses._bigrams_of(unit))
        for name, t in sorted(licenses.TEMPLATES.items()):
            own = set(licenses._bigrams_of(t))
            d = 2 * len(own & grams) / (len(own) + len(grams)) if grams else 0
            if d >= licenses.THRESHOLD and d > best[0]:
                best = (d, name)
        return best

    assert [(r.dice, r.license) for r in licenses.scan(frame).orderBy("doc_id").collect()] == [dice(x) for x in lines]
    assert all(r.license is None for r in licenses.scan(odd).collect())


def test_url_parts_rules_and_rejected_templates(spark):
    urls = ["HTTP://A.Example.org/es/1?q", "x", None, "http://b.org#f", "http://example.org/en/12", "http://spam.com", "http://C.com/fr/x"]
    urls += [f"http://bad.com/de/item{k}" for k in range(30)] + ["http://bad.com/other/item1", "http://bad.com/xx/yy"]
    got = [tuple(r)[1:5] for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()]
    assert got[:7] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("b.org", "", None, "allow"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("spam.com", "", None, "allow"), ("c.com", "/fr/x", "com/fr/", "allow"),
    ]
    assert got[7][3] == "block" and got[-1][3] == "block"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.01").select("doc_id", "round_trip").collect()
    ids = {r.doc_id for r in out}
    assert all(r.round_trip for r in out) and len(ids) == len(out)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    toxic = [r.doc_id in ids for r in labels if r.toxic]
    assert sum(toxic) <= 0.2 * len(toxic) and not any(r.doc_id in ids for r in labels if not r.quality)


def test_license_probes_see_separators_and_other_letters(spark):
    """Words are parted by any characters but ASCII letters and digits, also by letters whose lower case is ASCII."""
    texts = ["prose\n\nRELEASED --- under\tthe K MITéLicense!\nmore", "ReleasedKunder the MIT License", "xReleased under the MITx Licensey", "all\nrights\nreserved", "All rights reserved.\n" * 2 + "prose of another kind", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.license, r.dice, r.n_units) for r in licenses.scan(frame).orderBy("doc_id").collect()]

    def by_brute_force(text):
        text, best = text or "", {}
        for unit in {text, *re.split(r"\n[ \t\r]*\n", text), *text.split("\n")}:
            words = tuple(w.lower() for w in re.findall("[A-Za-z0-9]+", unit))
            grams = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or {f"{w} " for w in words}
            scores = [(2 * len(grams & own) / (len(grams) + len(own)), name) for name, t in licenses.TEMPLATES.items() for own in [set(licenses._bigrams_of(t))]]
            dice, name = min(scores, key=lambda s: (-s[0], s[1]))
            if dice >= licenses.THRESHOLD:
                best[words] = (-dice, name)
        dice, name = min(best.values(), default=(0.0, None))
        return name, -dice if name else 0.0, len(best)

    assert got == [by_brute_force(t) for t in texts]
    assert [name for name, _, _ in got] == ["mit", "mit", None, "all-rights-reserved", "all-rights-reserved", None, None]
