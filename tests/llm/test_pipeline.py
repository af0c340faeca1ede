"""The pipeline against plain versions of its stages."""

import random
import re

import pytest

import corpus_pipeline
from eventflow.llm import decontaminate, pii, simhash
from tests.llm.conftest import rows_of
from tests.llm.test_decontaminate import plain_tiles, words
from tests.llm.test_texts import ODD, plain_fingerprint
from tests.llm.test_toxicity import BAD, text

RNG = random.Random(21)


@pytest.fixture()
def corpus(spark, documents):
    truth = [RNG.random() < 0.25 for _ in range(500)]
    texts = [text(t) for t in truth]
    items = [" ".join(RNG.choices([f"q{i}" for i in range(90)], k=RNG.randint(16, 40))) for _ in range(5)]
    clean = [text(False) for _ in range(6)]
    extra = [clean[0], clean[0], clean[0].upper(), clean[0] + " end"]
    extra += [text(False) + " " + items[0], text(False) + "\n" + " ".join(items[1].split()[10:] + items[1].split()[:10])]
    extra += ["write to some.one@mail.example.com or +1 (988) 555-2485 " + text(False)]
    texts += clean + extra + ODD
    folder = documents(texts)
    spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(truth)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows_of(texts), truth, items


def test_stages_equal_plain_versions(spark, corpus, tmp_path):
    folder, rows, truth, items = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        seen.append(docs.collect())
    toxic, single, unseen, redacted, encoded = seen
    kept = {r["doc_id"] for r in toxic}
    assert len([i for i, t in enumerate(truth) if not t and i not in kept]) <= 8  # clean ones stay
    assert sum(t and i in kept for i, t in enumerate(truth)) <= 0.15 * sum(truth)
    assert len(toxic) + len([i for i in range(len(rows) - 2) if i not in kept]) == len(rows) - (0 not in kept)

    # near copies: one of each component, the smallest id
    group = {}
    fps = [(plain_fingerprint(r["text"]), r) for r in toxic]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][0] ^ fps[j][0]).bit_count() <= 4:
                parent[find(i)] = find(j)
    for i, (_, r) in enumerate(fps):
        group.setdefault(find(i), []).append(r["doc_id"])
    want = sorted([min((i for i in g if i is not None), default=None) for g in group.values()], key=repr)
    assert sorted((r["doc_id"] for r in single), key=repr) == want and len(want) < len(toxic) - 3

    def leaked(t):
        for it in items:
            kinds = {}
            item = [kinds.setdefault(w, len(kinds)) for w in words(it)]
            tiles = plain_tiles(item, [kinds.get(w, -1) for w in words(t)][:600], decontaminate.MIN_WORDS)
            if sum(k for _, _, k in tiles) >= decontaminate.THRESHOLD * len(item):
                return True
        return False
    assert sorted((r["doc_id"] for r in unseen), key=repr) == sorted((r["doc_id"] for r in single if not leaked(r["text"])), key=repr)
    assert len(single) - len(unseen) >= 2

    before = {r["doc_id"]: r["text"] for r in unseen}
    for r in redacted:
        assert r["text"] == pii.redact(before[r["doc_id"]], pii.find_spans(before[r["doc_id"]])) and r["n_chars"] == len(r["text"])
    assert any("[EMAIL]" in r["text"] and "[PHONE]" in r["text"] for r in redacted)

    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = {r["doc_id"]: r["text"] for r in redacted}
    assert len(encoded) == len(redacted)
    for r in encoded:
        ids = sp.encode(plain[r["doc_id"]])
        assert r["ids"] == ",".join(map(str, ids)) and r["n_tokens"] == len(ids) and r["decoded"] == sp.decode(ids)


def test_run_applies_all_stages_and_empty_tables(spark, corpus, no_documents):
    folder, rows, _, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert 0 < got.count() < len(rows) and not any(b in r["decoded"].split() for r in got.collect() for b in BAD[:1])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{no_documents}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{no_documents}/benchmark.parquet")
    assert corpus_pipeline.run(spark, no_documents).count() == 0


def test_near_copy_cells_are_not_broadcast(spark, documents, monkeypatch):
    seen, components = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges: seen.append(edges) or components(edges))
    rng = random.Random(4)
    base = [rng.choices([f"w{i}" for i in range(60)], k=300) for _ in range(30)]
    folder = documents([" ".join(w) for w in base] + [" ".join([*w[:-1], "edit"]) for w in base])
    kept = corpus_pipeline.keep_one_near_copy(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).count()
    assert kept < 55 and seen[0].collect()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastExchange" not in plan and re.search(r"SortMergeJoin(\(skew=true\))? \[cell#", plan)
