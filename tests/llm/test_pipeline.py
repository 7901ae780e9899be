"""The pipeline against its five stages in plain Python, on documents with planted cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from corpusmill.llm import decontaminate, pii, pu_classifier, simhash
from corpusmill.llm.common import table
from corpusmill.llm.queries import PSEUDONYM_KEY

draw = random.Random(12)
WORDS = [a + b + c for a in ("ka", "lo", "mi", "ter", "wen") for b in ("s", "nd", "r", "") for c in ("a", "eth", "o", "ing", "u")]
CARD, MAIL = "4111 1111 1111 1111", "anna.b@mail.example.com"


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def prose(n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


def junk(n):
    return " ".join(draw.choice(["!!!", "BUY", "$$$", "###", "NOW"]) for _ in range(n))


def planted():
    """Documents by kind: clean ones, junk, copies, near copies, benchmark passages as they are and edited, personal values."""
    items = [prose(25) for _ in range(4)]
    texts = [prose(draw.randint(120, 300)) for _ in range(60)] + [junk(150) for _ in range(25)]
    texts += [texts[3], texts[3].upper(), texts[4] + " end", texts[5] + "\nmore of it"]
    texts += [prose(150) + " " + items[0] + " " + prose(80), prose(90) + " " + items[1].upper()[:60] + "x" + items[1][61:] + " " + prose(60)]
    texts += [f"{prose(100)} {CARD} {prose(60)}", f"{prose(130)} {MAIL} and {CARD}. {prose(40)}", "", None, "short"]
    return texts, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts, items = planted()
    rows = [(i + 1, t, "en", f"s{i % 3}", len(t) if t is not None else None, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _judged string, n_pii int")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(i + 1, int(not (t or "").startswith(("!", "B", "$", "#", "N"))), 0) for i, t in enumerate(texts) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def distance(item, text):
    """Least edit distance of the item to any part of the text."""
    row = np.zeros(len(text) + 1, int)
    chars = np.array(list(text))
    for i, a in enumerate(item, 1):
        step = np.minimum(row[:-1] + (chars != a), row[1:] + 1)
        new = np.empty_like(row)
        new[0] = i
        new[1:] = step
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_stages_by_brute_force(spark, folder):
    from tokenizers import Tokenizer

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [decontaminate.normal(r["text"]) for r in table(spark, folder, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "near-dedup", "benchmark decontamination", "PII", "BPE encoding and decoding"]

    model = pu_classifier.train(pu_classifier.measured(docs), labels)
    good = {i for i, t in texts.items() if model.scores(np.array([pu_classifier.features_of(t or "")]))[0] >= 0.3}
    assert not any((texts[i] or "").startswith(("!", "B", "$", "#", "N")) for i in good) and len(good) >= 60

    prints = {i: simhash.fingerprint(texts[i] or "") for i in sorted(good)}
    root = {i: i for i in prints}
    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    single = {i for i, r in root.items() if i == r}
    assert len(good) - len(single) >= 2  # the copies at least

    clean = {i for i in single if not any(distance(x, decontaminate.normal(texts[i] or "")) <= decontaminate.budget(x) for x in items)}
    assert len(single) - len(clean) == 2

    new = {v: pii.pseudonymise(spark.createDataFrame([(v,)], "text string"), PSEUDONYM_KEY).first()["text"] for v in (CARD, MAIL)}
    private = {i: texts[i] and texts[i].replace(CARD, new[CARD]).replace(MAIL, new[MAIL]) for i in clean}
    assert sum(private[i] != texts[i] for i in clean) == 2

    want, at = [good, single, clean, clean], docs
    for (name, stage), kept in zip(corpus_pipeline.STAGES, want):
        at = stage(spark, at, folder)
        assert at.columns == docs.columns and at.dtypes == docs.dtypes, name
        rows = {r["doc_id"]: r for r in at.collect()}
        assert set(rows) == kept, name
    assert {i: r["text"] for i, r in rows.items()} == private
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) and (r["_judged"], r["n_pii"]) == ("x", 1) for r in rows.values())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for i, text in private.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, folder)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == expected


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_ids(spark, folder, tmp_path):
    docs = table(spark, folder, "documents")
    docs.unionByName(docs).unionByName(docs.where("doc_id = 2").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "* EXCEPT (doc_id)")).write.parquet(
        f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, folder, name).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(rows) == len(set(rows)) and 50 <= len(rows) <= 70
