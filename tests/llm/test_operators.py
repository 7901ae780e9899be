"""The training-data operators against brute force on small tables with every awkward row."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import (
    bpe, decontaminate, pii, pu_classifier, quality_rules, simhash, suffix_dedup, token_counts, token_files, url_filter,
)
from corpusmill.llm.common import table

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
WORDS = "the of and ing tion ered hah outh bleat éreau straße 日本 don't x1 .. ## | 12.5".split()
draw = random.Random(5)


def prose(n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


BASE = prose(300)
TEXTS = [
    None, "", " ", "\n\n", "a", "the the the the", BASE, BASE, BASE + " tail", "head " + BASE, BASE[:700] + "X" + BASE[700:],
    prose(5000), "x" * 3000, "ab" * 900, "no  double   spaces\t\tand \x00 \x1c odd\u00a0ones ▁▁", "<|endoftext|>a<|ENDOFTEXT|> <s>",
    "a \xa0 \xa0 \xa0b \n \n \nc\n \td \n\u2003 \u2003 \u2003e", "line\nline\nline\n\nother", "é" * 500, "😀 J̌ ﬁ Ω²",
]


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    """The shared folder, set only where the session has none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="module")
def docs(spark):
    """Ids with a repeated row and a null, and columns whose names the operators use themselves."""
    rows = [(i, t, "src0" if i % 3 else None, i, "k", 1, 0.5) for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, "an id is missing here", "src1", 0, "k", 1, 0.5)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_tokens long, key string, h int, score double"
    ).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def pairs(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def expected(docs, make):
    return Counter((r["doc_id"], *make(r["text"] or "")) for r in docs.collect())


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.NET/x?q#f", "x://net/", "x://net", "a://b://c/d", "http://Sub.Example.NET/en/1",
        "http://example.com/de/", "http://notexample.com/de/", "http://a.spam-x.com", "http://spam.com?x/y", "http://x.org/fr/#1",
        "http://é.org/fr/", "http://spam.com?x/y",
    ] + [f"http://h{i}.{'spam' if i % 5 == 0 else 'fine'}{i}.com/p" for i in range(400)]
    # bad labels deep inside long names
    urls += [f"http://{'.'.join(['a'] * n)}.{bad}.{'.'.join(['b'] * m)}.com/" for n in (1, 4) for m in (1, 6) for bad in ("spam", "fine")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
             url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
    listed = F.split("key", r"\.")[0].startswith("spam")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else None
        host = re.match(r"[^/?#]*", rest).group() if rest is not None else ""
        path = re.match(r"[^?#]*", rest[len(host):]).group() if rest is not None else ""
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        labels = host.split(".")
        bad = any(labels[i].startswith("spam") for i in range(max(1, len(labels) - 1)))
        return host, path, best and best.name, best.verdict if best else "block" if bad else "allow"

    want = Counter((i, *judge(u)) for i, u in enumerate(urls))
    for max_words in (8 << 20, 4):  # one filter, and many shards
        got = url_filter.judge_urls(pages, rules, listed, max_words=max_words)
        assert pairs(got, "page_id", "host", "path", "rule", "verdict") == want
    assert url_filter.judge_urls(pages.limit(0), rules, listed).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_listed_domains_come_from_the_pages(spark, sf):
    """Domains of which over a third of the pages are thin, subdomains included; the cascade has levels at every size."""
    from corpusmill.llm.queries import THIN

    pages = table(spark, f"/root/testdata/{sf}", "pages")
    total, thin = Counter(), Counter()
    for r in pages.select("url", "html").collect():
        host = re.match(r"[^/?#]*", r["url"].split("://", 1)[1]).group().lower()
        labels = host.split(".")
        for key in {host, *(".".join(labels[-n:]) for n in range(2, len(labels) + 1))}:
            total[key] += 1
            thin[key] += len(r["html"]) < THIN
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host"), (F.length("html") < THIN).alias("thin"))
    rule = 3 * F.col("failing") > F.col("rows")
    keys = url_filter.domain_keys(hosts, rule, F.col("thin"))
    want = {k: 3 * thin[k] > n for k, n in total.items()}
    assert {r["key"]: r["listed"] for r in keys.collect()} == want and any(want.values())
    found = url_filter.cascade(keys, sum(want.values()), len(want) - sum(want.values()))
    assert len(found.levels) >= 2
    assert {r["key"]: r["l"] for r in keys.select("key", found.lists(F.col("key")).alias("l")).collect()} == want


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, gram, group", [(400, 64, 2048), (60, 16, 2048), (60, 16, 1), (40, 8, 2)])
def test_suffix_dedup(spark, docs, empty, length, gram, group):
    rows = docs.collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(rows, brute_removed([r["text"] for r in rows], length)))
    got = suffix_dedup.removed(docs, length, gram, group)
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.removed(empty, length, gram, group).count() == 0


def test_suffix_dedup_many_contexts(spark):
    """One passage between different neighbours, in more texts than a group may hold."""
    passage = prose(60)
    texts = [prose(20) + passage + prose(20) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: w for i, w in enumerate(brute_removed(texts, 100))}
    for group in (3, 1000):
        got = suffix_dedup.removed(df, 100, 16, group).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_suffix_dedup_frequent_passage_is_split_by_many_tasks(spark, monkeypatch):
    own = random.Random(8)
    around = ["".join(own.choice("abcdefgh") for _ in range(50)) for _ in range(160)]
    hasher = suffix_dedup._Hasher(16)
    lowest = min("ijklmnopqrstuvwxyz", key=lambda c: hasher(np.frombuffer(c.encode() * 16, np.uint8))[0])
    texts = [a + lowest * 150 + b for a, b in zip(around[::2], around[1::2])]
    shares = []

    def split(contexts, width, length, old=suffix_dedup._split):
        rows = [r["count"] for r in contexts.groupBy(F.spark_partition_id()).count().collect()]
        shares.append(max(rows) / sum(rows))
        return old(contexts, width, length)

    monkeypatch.setattr(suffix_dedup, "_split", split)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = suffix_dedup.removed(df, 100, 16, 500).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = dict(enumerate(brute_removed(texts, 100)))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert shares and shares[0] < 0.5


def test_suffix_dedup_repeated_rows(spark):
    """Rows that repeat id and text are counted, not paired: 600 of 20 kB beside others that share parts of it."""
    long = "".join(draw.choice("abcdefgh \u00e9") for _ in range(20_000))
    rows = [(1, long)] * 600 + [(2, "x" + long[300:900]), (3, prose(200)), (None, None), (None, None), (4, "short")] + [(4, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = pairs(suffix_dedup.removed(df), "doc_id", "n_bytes", "n_removed", "n_spans")
    n, part = len(long.encode()), len(long[300:900].encode())
    other = brute_removed([rows[602 - 1][1]], 400)[0]
    assert got == Counter({(1, n, n, 1): 600, (2, part + 1, part, 1): 1, (3, *other[:3]): 1, (None, 0, 0, 0): 2, (4, 5, 0, 0): 2})


def test_bpe(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCAB)

    def digest(text):
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    assert pairs(bpe.code_digests(docs, VOCAB), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected(docs, digest)
    back = bpe.decode_table(bpe.encode_table(docs, VOCAB), VOCAB)
    assert pairs(back, "doc_id", "text") == expected(docs, lambda t: (t,))
    assert bpe.code_digests(empty, VOCAB).count() == 0


def test_bpe_random():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(VOCAB), bpe.ByteBpe(VOCAB)
    alphabet = ["a", "B", "the", "ING", " ", "  ", "\n", "é", "日", "12", "'s", "\x1c", "\x85", "😀", "!", "²", "_", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_quality_rules(spark, docs, empty):
    def count(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(zip(words, words[1:], words[2:]))
        inside = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)

    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality_rules.judge_documents(docs)
    assert pairs(judged, *columns) == expected(docs, count)
    rows = judged.collect()
    assert all(not r["kept"] or not r["base_failed"] for r in rows)
    assert {r["kept"] for r in quality_rules.judge_documents(docs, limit=0.0).collect()} == {False}
    assert quality_rules.judge_documents(empty).count() == 0


def test_pseudonyms(spark):
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    values = [card, card.replace(" ", "-"), iban, "anna.b+x@mail.example.com", "+1 (306) 555-4891", "123-45-6789", "10.0.255.3",
              "2024-02-29", "31.12.1999", "1/2/2003"]
    text = "; ".join(values) + "."
    left = "4111 1111 1111 1112; DE88 3704 0044 0532 0130 00; 000-45-6789; 10.0.256.3; 2023-02-29; v1.2.3; price 1234567"
    df = spark.createDataFrame(
        [(1, text, 7), (2, "a " + text, 7), (3, left, 7), (4, None, 7), (5, "", 7)], "doc_id long, text string, n_pii int"
    )
    rows = {r["doc_id"]: r for r in pii.pseudonymise(df, "k").collect()}
    assert rows[3]["text"] == left and rows[3]["n_pii"] == 0
    assert rows[4]["text"] is None and rows[5]["text"] == ""
    new = rows[1]["text"][:-1].split("; ")
    assert rows[1]["n_pii"] == len(values) and rows[2]["text"] == "a " + rows[1]["text"]
    assert all(a != b and re.sub(r"\d+", "0", re.sub("[a-zA-Z]", "a", a)) == re.sub(r"\d+", "0", re.sub("[a-zA-Z]", "a", b))
               for a, b in zip(values, new))
    assert new[0].replace(" ", "") == new[1].replace("-", "")  # linked across formats
    again = pii.pseudonymise(spark.createDataFrame([(1, new[0])], "doc_id long, text string"), "k").first()
    assert again["n_pii"] == 1  # still a valid card
    digits = new[2].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in digits[4:] + digits[:4])) % 97 == 1
    assert pii.pseudonymise(df.limit(0), "k").count() == 0


def test_permutations_are_one_to_one(spark):
    days = spark.range(73_000).select(pii.permuted_day(F.col("id").cast("int"), "k").alias("d"))
    assert days.agg(F.min("d"), F.max("d"), F.countDistinct("d")).first() == (0, 72_999, 73_000)
    numbers = spark.range(10_000).select(pii.feistel(F.lpad(F.col("id").cast("string"), 4, "0"), "x", "k").alias("n"))
    assert numbers.distinct().count() == 10_000


def test_edit_matches(spark, docs, empty):
    def distance(item, text):
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item, 1):
            last, row = row, [i] + [0] * len(text)
            for j, b in enumerate(text, 1):
                row[j] = min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1)
        return min(row)

    items = [prose(12) for _ in range(6)] + ["short", "", None]
    texts = ["before " + i + " after" for i in items if i]
    texts += [items[0][:20] + "ZZ" + items[0][23:], items[1][3:], items[2].upper().replace(" ", "\n"), None, "", prose(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            a, b = decontaminate.normal(item or ""), decontaminate.normal(t or "")
            if a and (n := distance(a, b)) <= decontaminate.budget(a):
                want.add((d, i, n))
    got = decontaminate.matches(df, bench)
    assert {tuple(r) for r in got.select("doc_id", "item_id", "distance").collect()} == want
    hit = {d for d, _, _ in want}
    kept = decontaminate.without_items(df, bench)
    assert kept.columns == df.columns and {r[0] for r in kept.collect()} == set(range(len(texts))) - hit
    assert decontaminate.matches(empty, bench).count() == 0 and decontaminate.matches(df, bench.limit(0)).count() == 0


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    files, index = token_files.write_tokens(docs, token_files.token_folder(spark), path, 2, sequence=16, batch=4)
    got = token_files.read_digests(files, index).collect()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at, want = 0, Counter()
    stream = []
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want[r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
        stream += ids
    assert Counter(map(tuple, got)) == want
    found = []
    for name, start, n in files.parts:
        reader = token_files.open_part(files, name)
        assert start == len(found)
        for k in range(-(-n // 16)):
            ids, mask = token_files.sequence_at(reader, k, 4)
            assert len(ids) == len(mask) == 16
            found += ids[mask].tolist()
    assert found == stream
    files, index = token_files.write_tokens(empty, token_files.token_folder(spark), path, 2)
    assert files.parts == () and token_files.read_digests(files, index).count() == 0


def brute_components(prints, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(spark, docs, empty):
    rows = docs.collect()
    prints = [simhash.fingerprint(r["text"] or "") for r in rows]
    root = brute_components(prints)
    least = {}
    for r, c in zip(rows, root):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, 1 << 60), r["doc_id"])
    want = Counter((r["doc_id"], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root))
    assert pairs(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # a component without any id keeps one row, as any other does
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([least.get(c) for c in set(root)])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_simhash_keeps_different_texts_of_one_id(spark):
    one, other = prose(60), "entirely different words " * 9 + prose(20)
    df = spark.createDataFrame([(1, one), (1, other), (1, one), (2, one), (None, other)], "doc_id long, text string")
    assert pairs(simhash.one_of_each(df), "doc_id", "text") == Counter([(1, one), (1, other)])


@pytest.mark.parametrize("block", [16_384, 7])
def test_simhash_links(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), replace=False)) for b in base for _ in range(4)]
    prints = sorted({*map(int, base), *near, 0, 1, (1 << 64) - 1})
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, block=block)).collect()}
    groups, want = {}, {}
    for p, c in zip(signed, brute_components(prints)):
        want.setdefault(c, set()).add(p)
        groups.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_fingerprint():
    from xxhash import xxh64_intdigest

    for text in ("", "One", "a B c", prose(40)):
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxh64_intdigest(g, 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("sf, accuracy, area", [("sf0.001", None, 0.9), ("sf0.01", 0.94, 0.95), ("sf0.1", 0.97, 0.98)])
def test_classifier_held_out(spark, sf, accuracy, area):
    """Accuracy on held-out labels (at least that of the commoner label) and the prior, at all sizes."""
    sf_dir = f"/root/testdata/{sf}"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    if accuracy:
        prior = pu_classifier.train(pu_classifier.measured(docs), labels).prior
        assert abs(prior - sum(known.values()) / len(known)) < 0.1
    rows = pu_classifier.score_documents(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["score"], r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    good, bad = ([s for s, _, q in held if q == v] for v in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > area
    right = sum(p == q for _, p, q in held) / len(held)
    assert right >= (accuracy or len(good) / len(held))


def test_risk_of_moments():
    """The risk and its least value, against the sums over single rows and a search by small steps."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(0.5, 1, (30, 4)), rng.normal(-0.2, 1, (80, 4))
    p[:, 0] = u[:, 0] = 1
    moments = [pu_classifier.Moments(len(x), x.sum(0), x.T @ x) for x in (p, u)]

    def risk(w, prior, ridge):
        loss = lambda x, sign: ((1 - sign * (x @ w)) ** 2 / 4).mean()
        bad = loss(u, -1) - prior * loss(p, -1)
        return prior * loss(p, 1) + max(0.0, bad) + ridge / np.sqrt(len(p)) * (w[1:] @ w[1:]) / 4, bad

    for x, m in zip((p, u), moments):
        w = rng.normal(0, 1, 4)
        for sign in (1, -1):
            assert m.risk(w, sign) == pytest.approx(((1 - sign * (x @ w)) ** 2 / 4).mean())
    for prior, ridge in ((0.3, 0.5), (0.9, 0.01), (0.97, 0.001)):
        w = pu_classifier.fit(*moments, prior, ridge)
        least, bad = risk(w, prior, ridge)
        assert bad > -1e-9
        for _ in range(3000):
            step = rng.normal(0, 10 ** rng.uniform(-4, 0), 4)
            assert risk(w + step, prior, ridge)[0] > least - 1e-7


def test_classifier_edges(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i != 12), "x") for i in range(14)] + [(3, 1, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    scored = pu_classifier.score_documents(docs, labels)
    assert pairs(scored, "doc_id") == expected(docs, lambda t: ())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored.collect())
    assert pu_classifier.score_documents(empty, labels).count() == 0
    assert {r["score"] for r in pu_classifier.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    trained_on = docs.filter(~pu_classifier.held_out(F.col("doc_id")))
    every = trained_on.select("doc_id", F.lit(1).alias("quality"))
    assert {r["score"] for r in pu_classifier.score_documents(trained_on, every).collect()} == {0.5}
    kept = pu_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_row_filters_take_any_columns(spark):
    rows = [(i, f"text number {i} of the card", "a", True, "b") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _judged string, _good boolean, _clean string")
    labels = df.select("doc_id", F.lit(1).alias("quality"))
    assert pu_classifier.keep_good(df, labels).columns == df.columns
    items = spark.createDataFrame([(1, "number 7 of")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.without_items(df, items).collect()} == set(range(30)) - {7}
    clash = df.selectExpr("doc_id", "text", "1 AS h", "2 AS print", "3 AS n", "4 AS `row`", "5 AS `a.b`", "6 AS least")
    kept = simhash.one_of_each(clash)
    assert kept.columns == clash.columns and kept.select("print", "`a.b`").distinct().collect() == [(2, 5)]


def test_token_counts(spark, docs, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = expected(docs, lambda t: (len(t.encode()), (n := len(library.encode(t))), n > 1000))
    assert pairs(token_counts.count_tokens(docs, path, 1000), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(empty, path).count() == 0
    counter = token_counts.PieceCounter(path)
    alphabet = ["a", "the", "ING", " ", "   ", "\n", "é", "日", "12", "\x00", "😀", "▁", "aaaa", "ing", "<s>", "."]
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30)))
        assert counter.count(text) == len(library.encode(text))
