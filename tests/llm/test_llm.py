"""The operators against brute force on small documents, with nulls, empty and long texts, repeats, and clashing columns."""

import base64
import hashlib
import json
import random
import re
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumengrid.llm import bpe, chat, common, decontaminate, exact_dedup, licenses, near_dedup, pii, quality, toxicity, warc
from tests.conftest import SF

RND = random.Random(11)
WORDS = ["the", "of", "Alpha", "beta", "gamma", "delta", "über", "naïve", "x1", "9"]


def sentence(n, rnd=RND):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [sentence(n) for n in (1, 2, 3, 5, 20, 60, 120, 200, 300) for _ in range(4)]
    long = sentence(40_000)
    out = [*base, *base[5:20], None, "", " ", "\n\t", base[9] + "  ", base[9].replace(" ", " \n"), long, long + " more", "a" * 300_000]
    for t in base[16:30]:
        w = t.split()
        for _ in range(6):
            v = list(w)
            v[RND.randrange(len(v))] = "edit" + str(RND.randrange(1000))
            out.append(" ".join(v))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0, 0.5, "k", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[5], None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, drop_id string, hits int").repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def test_hashes():
    t = "one two\nthree  öne " * 3
    got = common.word_hashes(t.encode())
    assert len(got) == 12 and list(got[:4]) == list(got[4:8]) and len(set(got.tolist())) == 4
    assert list(common.word_hashes(t.encode(), most=7)) == list(got)
    parts = common.many_word_hashes([b"a b", b"", b"  ", b"b c"])
    assert [len(p) for p in parts] == [2, 0, 0, 2] and parts[0][1] == parts[3][0]


def test_fingerprint_composes():
    for n in (0, 1, 4095, 4096, 4097, 20_000, 1_500_000):
        data = bytes(RND.randrange(256) for _ in range(min(n, 5000))) * (n // 5000 + 1)
        data = data[:n]
        whole = exact_dedup.fingerprint(data)
        for cut in (0, 1, n // 3, n):
            assert exact_dedup.combine(exact_dedup.fingerprint(data[:cut]), exact_dedup.fingerprint(data[cut:]), n - cut) == whole
    slow = [0] * 4
    for b in b"\0abc\0":
        slow = [(s * base + b + 1) % exact_dedup.PRIME for s, base in zip(slow, exact_dedup.BASES)]
    assert tuple(slow) == exact_dedup.fingerprint(b"\0abc\0") != exact_dedup.fingerprint(b"abc\0")


def test_segments(spark, texts):
    rows = [(i, k, t[k * 50 : k * 50 + 50]) for i, t in enumerate(x for x in texts if x) if len(t) < 3000 for k in range(-(-len(t) // 50))]
    got = exact_dedup.fingerprint_segments(spark.createDataFrame(rows, "doc_id long, segment_no int, text string"))
    want = {i: exact_dedup._packed(exact_dedup.fingerprint(t.encode())) for i, t in enumerate(x for x in texts if x)}
    for r in got.collect():
        assert (r.fp_a, r.fp_b) == want[r.doc_id]


def test_exact_dedup(docs, texts, nothing):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[5])]
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = Counter((i, min(x for x in groups[norm(t)] if x is not None), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)
    got = exact_dedup.exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_dedup_collision(docs, texts, monkeypatch):
    """With a fingerprint that always collides, comparison parts what differs."""
    monkeypatch.setattr(exact_dedup, "digests", lambda d, *_: d.select("doc_id", F.lit(1).cast("long").alias("fp_a"), F.lit(2).cast("long").alias("fp_b"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")))
    small = docs.where("doc_id < 60")
    got = exact_dedup.exact_dedup(small).collect()
    count = Counter(t or "" for i, t in enumerate(texts) if i < 60)
    count[texts[3]] += 1
    assert all(r.group_size == count[texts[r.doc_id] or ""] for r in got)


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    par[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup(docs, texts, nothing):
    want = brute_near(enumerate(texts))
    got = near_dedup.near_dedup(docs).collect()
    assert len(got) == len(texts) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_dedup(nothing).count() == 0


def test_near_dedup_chain_and_families(spark):
    """Chains that only hold link by link, and families that lie just below the threshold, so that buckets hold several components."""
    rnd = random.Random(5)
    rows = []
    for f in range(6):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(80)]
        for _ in range(25):
            v = list(base)
            for _ in range(rnd.choice([1, 2, 3, 5, 7])):
                v[rnd.randrange(80)] = f"e{rnd.randrange(10**6)}"
            rows.append(" ".join(v))
        for _ in range(12):
            base = list(base)
            base[rnd.randrange(80)] = f"c{rnd.randrange(10**6)}"
            rows.append(" ".join(base))
    rows = list(enumerate(rows))
    rnd.shuffle(rows)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_near(rows)


def test_sketch_estimates():
    rng = np.random.default_rng(2)
    for n, keep in ((50, 0.9), (500, 0.85), (5000, 0.5), (5000, 0.0)):
        errors = []
        for _ in range(20):
            common_ = rng.integers(0, 2**63, int(n * keep), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([common_, rng.integers(0, 2**63, n - len(common_), dtype=np.uint64)]) * np.uint64(2)) for _ in range(2))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            est = near_dedup.estimate(near_dedup.sketch(a)[None], near_dedup.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(est - true)
        assert abs(np.mean(errors)) < 0.03


def brute_contamination(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        k = min(13, len(v))
        for s in {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else ():
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) == s:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination(spark, nothing):
    items = [("a", sentence(20)), ("b", "Short, item"), ("c", ""), ("d", None), ("e", "word"), ("f", sentence(14)), (None, "x y"), ("g", sentence(13))]
    rows = [None, "", "word", "Words", "short item!", "short  ITEM short item", items[0][1], "pre " + items[0][1].upper().replace("Ü", "ü") + " post", sentence(30) + " " + " ".join(items[5][1].split()[:13]) + " " + sentence(300), " ".join(items[0][1].split()[:12]), items[0][1] + " " + items[0][1], "a" * 100_000, items[7][1].replace(" ", "--")]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = {i: brute_contamination(t, [x for x in items if x[0] is not None]) for i, t in enumerate(rows)}
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == want
    many = decontaminate.hits(docs, bench, most=600)
    assert {r.doc_id: sorted(r._hits["items"]) for r in many.collect()} == {r.doc_id: sorted(r._hits["items"]) for r in decontaminate.hits(docs, bench).collect()}
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated or n_hit > 0").count() == 0


def test_stages_follow_the_operators_row_by_row(spark):
    """Null and repeated ids: each row stays or goes by its own text."""
    a, b = sentence(40), " ".join(reversed(sentence(60).split()))
    near = a + " more"
    rows = [(1, a, "1a"), (None, a, "na"), (None, a + " ", "na "), (3, b, "3b"), (3, a, "3a"), (None, "quite alone here", "nq"), (4, a, "4a"), (None, None, "n0"), (6, "", "6")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string")
    kept = lambda df: sorted(r.own for r in df.collect())
    assert kept(exact_dedup.stage(spark, docs.where("own != 'na '"), "")) == ["1a", "3b", "6", "nq"]
    assert kept(exact_dedup.stage(spark, docs, "")) == ["1a", "3b", "6", "na ", "nq"]
    assert kept(exact_dedup.stage(spark, docs.where("own in ('1a', '3b', '4a')"), "")) == ["1a", "3b"]
    assert kept(near_dedup.stage(spark, docs.unionByName(spark.createDataFrame([(None, near, "nn")], docs.schema)), "")) == ["1a", "3b", "6", "n0", "nn", "nq"]  # nn: no row with an id has its set
    assert near_dedup.stage(spark, docs, "").columns == exact_dedup.stage(spark, docs, "").columns == docs.columns


def test_decontamination_by_items_without_an_id(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "alpha beta gamma"), (4, "delta")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "alpha beta"), (None, "gamma"), ("g", "gamma")], "item_id string, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for most in (decontaminate.MAX_PATTERN_BYTES, 1):
        found = decontaminate.hits(docs, bench, most=most)
        assert {r.doc_id: set(r._hits["items"]) for r in found.collect()} == {1: {None}, 2: {None, "g"}, 3: {None, "g"}, 4: set()}
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (2, 2, 1, sha(""), True), 2: (1, 1, 2, sha("g"), True), 3: (3, 3, 2, sha("g"), True), 4: (1, 0, 0, sha(""), False)}


def test_wu_manber():
    rnd = random.Random(3)
    for _ in range(60):
        text = "".join(rnd.choice("ab c") for _ in range(200)).encode()
        pats = list({text[i : i + rnd.randrange(1, 12)] for i in [rnd.randrange(190) for _ in range(8)]} | {b"zz"})
        want = sorted((i, p) for p in pats for i in range(len(text)) if text.startswith(p, i))
        starts = array("i", [sum(map(len, pats[:i])) for i in range(len(pats))])
        search = decontaminate.WuManber.build(b"".join(pats), starts, array("i", map(len, pats)))
        assert sorted((at, pats[i]) for at, i in search.find(text)) == want


def test_warc(spark, tmp_path):
    rows = [(1, "u", "<p>a</p>"), (2, "u\nv", "<p>a</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 70_000), (6, "x", "WARC/1.1\r\n\r\n"), (None, "n", "<p>a</p>"), (0, "z", "late"), (7, "z", "late"), (7, "z", "late")] + [(100 + i, "h", "hot") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit(1))
    archives = warc.pages_to_archives(pages.repartition(2))
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        f = first.get(h or "")
        revisit = i is not None and i > f
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", f if revisit else None)] += 1
    for size in (1 << 20, 200, 37):
        got = warc.read_archives(archives, size, 6)
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == want
        assert got.where("not intact").count() == 0
    assert warc.read_archives(warc.pages_to_archives(pages.where("false"))).count() == 0


def test_bpe_like_the_library(spark, texts, nothing):
    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    lib.no_truncation(), lib.no_padding()
    odd = ["I'll can't ΣΑΣ İstanbul ﬁ ½ x² Ⅷ ''s 's", "<|endoftext|>a<|startoftext|> b", "a​b é 😀\x1c日本語 ١٢٣", "ẞ ŉ\u0085c"]
    rows = [*texts[:60], *odd]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for share in (bpe.FREQUENT, 0.01):
        for r in bpe.encoded(docs, frequent=share, with_texts=True).collect():
            want = lib.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
            assert r.ids == want and r.n_tokens == len(want) and r.decoded == lib.decode(want, skip_special_tokens=False)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encoded(nothing).count() == 0


def test_lexicon(tmp_path):
    words = {w.encode(): [i, i + 1][: 1 + i % 2] for i, w in enumerate({"".join(RND.choice("abé") for _ in range(RND.randrange(1, 7))) for _ in range(400)} | {"singing", "ringing", "sing", "ring"})}
    blob = bpe.compile_lexicon(words)
    (tmp_path / "l").write_bytes(blob)
    lexicon = bpe.Lexicon.mapped(str(tmp_path / "l"))
    keys = list(words)
    assert lexicon.find(keys) == [words[k] for k in keys]
    assert lexicon.find([b"", b"zz", b"singingg", b"si", b"x" * 99]) == [None] * 5
    assert len(lexicon.keys) < sum(map(len, keys))
    assert bpe.Lexicon(bpe.compile_lexicon({})).find([b"a"]) == [None]


def test_chat(spark):
    known = chat.registry()
    cases = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 3}, "messages", [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "messages": [{"role": "user", "content": "a"}]}, "system_messages", [("system", "s"), ("user", "a")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "from_value", [("user", "a"), ("assistant", "b")]),
        ({"prompt": "a", "response": "b"}, "prompt_response", [("user", "a"), ("assistant", "b")]),
        ({"instruction": "a", "input": "c", "output": "b"}, "instruction", [("user", "a\nc"), ("assistant", "b")]),
        ({"instruction": "a", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
        ({"role": "user", "turn": 1}, "turn_row", [("user", "")]),
        ({"other": 1}, None, []),
        ({"messages": [{"role": "user", "content": "a", "name": "n"}], "tools": None}, "messages", [("user", "a")]),
        ({"prompt": "a", "completion": "b", "lang": "en"}, "prompt_completion", [("user", "a"), ("assistant", "b")]),
        ({"prompt": "a", "completion": 0, "extra": {"deep": [1]}}, "prompt_completion", [("user", "a"), ("assistant", "0")]),
        ({"system": "s", "messages": [{"role": "user", "content": "a"}], "source": "x"}, "system_messages", [("system", "s"), ("user", "a")]),
        ({"messages": []}, "messages", []),
        ({"messages": ["a"]}, None, []),
        ({"messages": [{"role": "user", "content": "a"}, 3]}, None, []),
        ([1], None, []),
        (None, None, []),
    ]
    for record, name, turns in cases:
        assert chat.canonical(record, known) == (name, turns)
    for text in ("", "<|im_end|>", "\\<|", "a\\n<\\|b|>", "<<|im_start|>user\n", "\\"):
        p, a, b = chat.piece("assistant", text)
        assert chat.read_back(p + chat.piece("user\nx", text)[0]) == [("assistant", text), ("user\nx", text)] and chat.unescape(p[a:b]) == text
    rows = [(i, t, r, x) for i in range(3) for t, (r, x) in enumerate([("user", "hi <|im_end|>"), ("assistant", None), ("assistant", "é\\n"), (None, "x" * 5000)])] + [(9, 1, "assistant", "b"), (9, 1, "assistant", "a"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = df.select("conv_id", "turn", F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.turns_of(records, "conv_id", "turn", "record"))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(own) and g.loss_chars == len(loss) and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert g.formatted_chars == sum(len(chat.piece(r, x)[0]) for _, r, x in own)


def test_quality_rules_compile(spark, nothing):
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(quality.STATS)))
    y = ((x[:, 4] > 0.5) & (x[:, 10] < 0.7)).astype(float)
    model = quality.fit(x, y)
    p = model.score(x)
    assert ((p > 0.5) == y).mean() > 0.97 and 0 < len(model.rules) < 120
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"{s} double" for s in quality.STATS))
    assert np.allclose([r.s for r in df.select(model.column().alias("s")).collect()], p[:200])
    assert quality.fit(np.zeros((0, 21)), np.zeros(0)).score(np.zeros((1, 21)))[0] == 0.5
    assert quality.statistics(b"")[1:] == [0.0] * 20 and len(quality.statistics("é !!".encode())) == 21


def metrics(rows, labels, held):
    rows = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out == held and r.doc_id in labels]
    right = sum(int(p == y) for _, y, p in rows)
    return right / len(rows)


@pytest.mark.parametrize("op,label", [("quality", "quality"), ("toxicity", "toxic")])
def test_classifiers_held_out(spark, op, label):
    d = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    f = {"quality": quality.quality, "toxicity": toxicity.toxicity}[op]
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "plain text")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    noisy = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5 * 10**6, 1, 1)], labels.schema))
    got = f(both.withColumn("label", F.lit("x")), noisy).collect()
    assert len(got) == docs.count() + 3 and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    assert metrics(got, truth, True) > 0.85
    assert {r.doc_id: r.score for r in got}[10**6] == {r.doc_id: r.score for r in got}[10**6 + 1]
    assert len({r.score for r in f(both, labels.where("false")).collect()}) == 1
    assert f(both.where("false"), labels).count() == 0


def test_crf_gradients_and_spans(spark):
    rng = np.random.default_rng(0)
    emit, there = rng.standard_normal((3, 5, 2)), np.array([[1] * 5, [1] * 3 + [0] * 2, [1] + [0] * 4], dtype=bool)
    trans, start = rng.standard_normal((2, 2)), rng.standard_normal(2)
    p, moved, z = toxicity._forward_backward(emit, there, trans, start)
    import itertools

    total = np.zeros((2, 2))
    for n in range(3):
        k = int(there[n].sum())
        score = {y: start[y[0]] + sum(emit[n, t, y[t]] for t in range(k)) + sum(trans[y[t - 1], y[t]] for t in range(1, k)) for y in itertools.product((0, 1), repeat=k)}
        norm = np.log(sum(np.exp(v) for v in score.values()))
        assert abs(norm - z[n]) < 1e-9
        for t in range(k):
            assert abs(sum(np.exp(v - norm) for y, v in score.items() if y[t]) - p[n, t]) < 1e-9
        for y, v in score.items():
            for t in range(1, k):
                total[y[t - 1], y[t]] += np.exp(v - norm)
    assert np.allclose(total, moved)
    windows = [(["you", "Fool", "go"], [0, 1, 0], True), (["a", "b", "fool"], [0, 0, 1], True), (["nice", "day"], [0, 0], False)] * 30
    model = toxicity.fit_crf(windows, toxicity.known_features(windows, ["fool"]))
    df = spark.createDataFrame([(1, "Well, Fool! Ünd fool"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.word) for s in r.spans] for r in toxicity.spans(df, model).collect()}
    assert got == {1: [(6, 10, "Fool"), (16, 20, "fool")], 2: []}


def test_licences(spark, nothing):
    mit = "MIT License\n\n" + ". ".join(s.capitalize() for k, s in licenses.SENTENCES.items() if k in ("mit-grant", "mit-notice", "mit-as-is")) + "."
    rows = [None, "", "Released under the MIT License.\nmore", mit, mit.replace(" and ", "\nand "), "Licensed under the Apache License, Version 2.0.", "license to nothing", "Licensed under CC BY-NC 4.0. Released under the MIT license.", licenses.SENTENCES["bsd-grant"] + ":\n" + licenses.SENTENCES["bsd-source"] + ".\n" + licenses.SENTENCES["bsd-binary"] + "."]
    got = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got == {0: "", 1: "", 2: "MIT", 3: "MIT", 4: "MIT", 5: "Apache-2.0", 6: "", 7: "CC-BY-NC-4.0,MIT", 8: "BSD-2-Clause"}
    assert licenses.licences(["mit-as-is", "mit-notice", "mit-grant"]) == []
    assert licenses.scan(nothing).count() == 0


#: The known licence sentences as they stand in real headers and licence files, with their marks and line ends.
REAL = {
    "mit-released": "Released under the\nMIT License.",
    "mit-licensed": "Licensed under the MIT\nlicense.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT',
    "apache-licensed": "Licensed under the Apache License,\nVersion 2.0.",
    "apache-licensed-the": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance\nwith the License.",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "gpl3-work": "This work is licensed under the GNU General Public License,\nversion 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "gpl-no-warranty": "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "bsd-source": "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.",
    "bsd-binary": "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.",
    "bsd-name": "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this file,",
    "cc-by": "Licensed under\nCC BY 4.0.",
    "cc-by-sa": "Licensed under\nCC BY-SA 4.0.",
    "cc-by-nc": "Licensed under\nCC BY-NC 4.0.",
    "unlicense": "This is free and unencumbered software released into\nthe public domain.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "lgpl3-free": "This library is free software: you can redistribute it and/or modify\nit under the terms of the GNU Lesser General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published\nby the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:",
    "cc0-dedicated": "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide.",
    "bsd-names": "The names of its contributors may not be used to endorse or promote\nproducts derived from this software without specific prior written permission.",
    "mit-file": "This file is licensed under the MIT License.",
    "mit-terms": "This software library is licensed under the terms of\nthe MIT license.",
    "apache-file": "This project is licensed under the Apache License, Version 2.0.",
    "apache-title": "                                 Apache License\n                           Version 2.0, January 2004",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "bsl1-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "cc0-title": "CC0 1.0 Universal",
    "unlicense-refer": "For more information, please refer to <http://unlicense.org/>",
    "unlicense-refer-s": "For more information, please refer to <https://unlicense.org>",
}


def test_licence_sentences_as_they_stand():
    assert set(REAL) == set(licenses.SENTENCES)
    for name, text in REAL.items():
        for form in (text, " ".join(text.split()), text.replace("\n", "\r\n"), "/*\n * " + text.replace("\n", "\n * ") + "\n */", "# " + text.replace("\n", "\n# "), "// " + text.replace("\n", "\n// "), "-- " + text.replace("\n", "\n-- "), f"Some words.\n\n{text}\n\nMore words."):
            assert licenses.identify(form) == [name], (name, form)
    gpl = lambda name: licenses.licences(licenses.identify(REAL[name] + "\n\n" + REAL["gpl-no-warranty"]))
    assert gpl("gpl-free") == ["GPL-3.0-or-later"] and gpl("gpl2-free") == ["GPL-2.0-or-later"]
    assert licenses.licences(licenses.identify(REAL["mpl-subject"])) == ["MPL-2.0"]
    mixed = "Released under the MIT License.\nThis program is distributed in the hope that it will be useful, but WITHOUT\nANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A\nPARTICULAR PURPOSE.\nLicensed under CC BY 4.0.\nNot licensed under the MIT license."
    assert licenses.identify(mixed) == ["mit-released", "gpl-no-warranty", "cc-by"]


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii_ok(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(int(c) * (1 + i % 2) // 10 + int(c) * (1 + i % 2) % 10 for i, c in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def brute_pii(t):
    found = sorted((m.start(), pii.KINDS.index(k), m.end()) for k in pii.KINDS for m in re.finditer(PII[k], t or "") if pii_ok(k, m.group()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in found)


def test_personal_data(spark, nothing):
    rnd = random.Random(5)
    parts = ["a", "B", "@", ".", "1", "22", "255", "999", "4111", " ", "-", "+", "(", ")", "_", "%", "é", "😀", "\n", "4111 1111 1111 1111", "a@b.c"]
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 60))) for _ in range(150)] + [None, "", "1 " * 5000, "a" * 50_000, "1" * 20_000, "a@b.co " * 500]
    docs = spark.createDataFrame([*enumerate(rows), (None, "x@y.zz")], "doc_id long, text string").withColumn("value", F.lit(1))
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i, t in enumerate(rows):
        want = brute_pii(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert not want or set(want.split(",")) <= set(got[i].spans.split(","))
    assert got[None].n_email == 1 and len(got) == len(rows) + 1
    assert pii.personal_data(nothing).count() == 0


def test_personal_data_bootstraps(spark):
    rows = [f"call me mail u{i}@host.org now" for i in range(20)] + ["please mail u77(at)host now", "mail nobody now"] + [f"the year 19{i} was" for i in range(20)]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got[20] == "email:12:23" and got[21] == "" and got[25] == ""


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = common.saved(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
            kept = {r.doc_id for r in after.select("doc_id").collect()}
            if name == "exact_dedup":
                norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
                first = {}
                for r in docs.collect():
                    first[norm(r.text)] = min(r.doc_id, first.get(norm(r.text), r.doc_id))
                assert kept == set(first.values())
            elif name == "near_dedup":
                want = brute_near([(r.doc_id, r.text) for r in docs.collect()])
                assert kept == {i for i, (_, c) in want.items() if i == c}
            elif name == "decontamination":
                items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
                assert kept == {r.doc_id for r in docs.collect() if not brute_contamination(r.text, items)[4]}
            else:
                scored = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
                assert kept == {i for i, p in scored.items() if not p}
        docs = after
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect())) and whole.count() > 0


def test_json_records_round_trip():
    assert chat.fingerprint(chat.paths(json.loads('{"a": [{"b": 1}, {"c": []}]}'))) == chat.fingerprint({"a[].b", "a[].c[]"})
