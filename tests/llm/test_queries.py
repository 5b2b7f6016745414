"""Registered queries against their SQL, and the pipeline against a plain one."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from checks.compare import compare, duck
from plotwise.llm import toxicity
from plotwise.llm.packing import vocabulary_path
from plotwise.llm.queries import ORACLES, QUERIES
from plotwise.llm.subwords import plain, subwords

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_all_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_row(spark, name):
    rows = QUERIES[name](spark, SF)
    ids = Counter(r["doc_id"] for r in rows.collect())
    known = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert set(ids) == known and (name.startswith("op9") or set(ids.values()) == {1})


def documents(spark, folder, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_secrets_are_counted_by_kind(spark, tmp_path):
    keys = "AKIA" + "Q7" * 8, "AKIA" + "Z9" * 9
    hexes = "0a" * 12, "9f" * 15, "77" * 13
    texts = [
        (1, f"password = abcdef and {keys[0]} {keys[1]}"),
        (2, f"é {hexes[0]} {hexes[1]} {hexes[2]} AKIAQ7"),
        (2, f"😀 {hexes[0]} {keys[0]}"),
        (3, "token=abcde"), (4, None), (None, "Secret:'abcdef'"),
    ]
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in QUERIES["op2_secret_scan"](spark, documents(spark, tmp_path, texts)).collect())
    assert got == Counter([
        (1, 1, 2, 0, digest([("assign", 0, 17), ("access", 22, 42), ("access", 43, 65)])),
        (2, 0, 0, 3, digest([("hex", 2, 26), ("hex", 27, 57), ("hex", 58, 84)])),
        (2, 0, 1, 1, digest([("hex", 2, 26), ("access", 27, 47)])),
        (3, 0, 0, 0, digest([])), (4, 0, 0, 0, digest([])), (None, 1, 0, 0, digest([("assign", 0, 14)])),
    ])


def test_personal_data_is_counted_by_kind(spark, tmp_path):
    texts = [
        (1, "a@b.com 1.2.3.4 5.6.7.8 9.9.9.9 256.1.1.1"),
        (2, "é 4111 1111 1111 1111, +1 555 123 4567 and +49 30 123 4567"),
        (2, "x@y.org z@y.org"), (4, None), (None, "10.0.0.1"),
    ]
    rows = QUERIES["op6_personal_data"](spark, documents(spark, tmp_path, texts)).collect()
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
    ips = [("ip", 8, 15), ("ip", 16, 23), ("ip", 24, 31)]
    assert got == Counter([
        (1, 1, 3, 0, 0, digest([("email", 0, 7), *ips])),
        (2, 0, 0, 1, 2, digest([("card", 2, 21), ("phone", 23, 38), ("phone", 43, 58)])),
        (2, 2, 0, 0, 0, digest([("email", 0, 7), ("email", 8, 15)])),
        (4, 0, 0, 0, 0, digest([])), (None, 0, 1, 0, 0, digest([("ip", 0, 8)])),
    ])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_toxic(docs, labels):
    """Ids whose highest passage scores 0.3, word by word."""
    rows = [(i, t, labels[i]) for i, t, _ in docs if i in labels and zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(rows) < toxicity.MAX_ROWS
    rows.sort(key=lambda r: (r[0], r[1]))
    model = toxicity.fit([t or "" for _, t, _ in rows], [y for _, _, y in rows])
    folded, offset = model.folded()
    known = {}

    def score(word):
        if word not in known:
            grams = [g for _, found in subwords(plain(pa.array([word])), toxicity.SHORTEST, toxicity.LONGEST, toxicity.BITS) for g in found]
            known[word] = np.mean(folded[grams]) if grams else 0.0
        return known[word]

    out = set()
    for i, t, _ in docs:
        each = [score(w) for w in WORD.findall(t or "")]
        n = min(len(each), toxicity.PASSAGE)
        best = max((np.mean(each[k : k + n]) for k in range(len(each) - n + 1)), default=-math.inf) if n else -math.inf
        if 1 / (1 + math.exp(-max(min(best + offset, 60), -60))) >= 0.3:
            out.add(i)
    return out


def plain_near(docs, k=5):
    sets = {}
    for i, t, _ in docs:
        words = WORD.findall(lower(t))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [d for d in docs if root(d[0]) == d[0]]


def unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


def plain_mix(docs):
    sizes = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    per_source = defaultdict(int)
    for i, _, s in docs:
        per_source[s] += sizes[i]
    names = sorted(per_source)
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    open_, left, target = set(names), 1.5 * sum(per_source.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * per_source[s]]
        for s in over or list(open_):
            target[s] = 2.0 * per_source[s] if over else level * weight[s]
            left -= target[s] if over else 0
            open_.discard(s)
    copies = {}
    for s in names:
        own = [i for i, _, x in docs if x == s]
        own.sort(key=lambda i: (math.floor(math.log2(sizes[i] + 1) * 16), math.floor(unit(f"7|{i}") * 256), sizes[i], i))
        rate, u = target[s] / per_source[s] if per_source[s] else 0.0, unit(f"7|offset|{s}")
        for n, i in enumerate(own, 1):
            copies[i] = math.floor(n * rate + u) - math.floor((n - 1) * rate + u)
    return copies


def test_pipeline(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    docs = [(r.doc_id, r.text, r.source) for r in rows]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    toxic = plain_toxic(docs, labels)
    assert 0 < len(toxic) < len(docs) / 3
    docs = [d for d in docs if d[0] not in toxic]
    last = {lower(t): i for i, t, _ in docs}  # in order of id: the largest stays
    docs = [d for d in docs if last[lower(d[1])] == d[0]]
    docs = plain_near(docs)
    copies = plain_mix(docs)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = Counter()
    for i, t, _ in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            want[i, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += copies[i]
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +want
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096 and len(fill) <= math.ceil(sum(fill.values()) / 4096) + 1


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mix", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
