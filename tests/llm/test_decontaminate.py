"""Greedy string tiling against its definition, and decontamination against tiling every pair."""

import random
import re

from eventflow.llm.decontaminate import tiles
from eventflow.llm.queries import QUERIES
from tests.llm.conftest import rows_of
from tests.llm.test_texts import ODD, by_row

RNG = random.Random(9)


def plain_tiles(item, text, least):
    """Again and again the longest match of unmarked words, the first of equals."""
    ui, ut, out = [x < 0 for x in item], [x < 0 for x in text], []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not ui[i + k] and not ut[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return out
        ui[i:i + k] = [True] * k
        ut[j:j + k] = [True] * k
        out.append((i, j, k))


def test_tiles_are_longest_first():
    for _ in range(300):
        kinds = RNG.choice([2, 4, 30])
        item = [RNG.randrange(kinds) for _ in range(RNG.randint(0, 40))]
        text = [RNG.randrange(-1, kinds) for _ in range(RNG.randint(0, 50))]
        if item and RNG.random() < 0.7:
            cut = RNG.randrange(len(item))
            text += item[cut:] + [-1] + item[:cut]
        assert sorted(tiles(item, text, 3)) == sorted(plain_tiles(item, text, 3))


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def test_op6_equals_tiling_every_pair(spark, documents):
    vocab = [f"t{i}" for i in range(400)] + ["é", "日本"]
    say = lambda n: " ".join(RNG.choices(vocab, k=n))
    items = [say(RNG.randint(16, 60)) for _ in range(12)] + [None, "", "two words", say(200), "same " * 9, "t7", say(3), say(4), say(5), say(9), say(12), say(13)]
    texts = list(ODD)
    for it in [i for i in items if i and len(i.split()) > 9]:
        w = it.split()
        a, b = len(w) // 3, 2 * len(w) // 3
        texts += [say(50) + ". " + it.upper() + "! " + say(20), " ".join(w[b:] + ["x"] + w[:a] + ["y"] + w[a:b]),
                  say(30) + " " + " ".join(w[:b]), say(30) + " " + " ".join(w[:a]) + " " + say(9), ", ".join(w)]
    texts += [say(300) for _ in range(20)] + ["same " * 3000]
    for it in items[-6:]:  # whole, reordered, and with a word changed
        w = it.split()
        texts += [f"{say(9)} {it}, {say(9)}", " ".join(w[5:] + w[:5]), " ".join(w[:-1] + ["other"] + w[-1:]), " ".join(w[:5])]
    folder = documents(texts)
    spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(items)] + [(0, items[0], 2.0)], "item_id long, text string, doc_id double").write.parquet(
        f"{folder}/benchmark.parquet")
    got = QUERIES["op6_decontaminate"](spark, folder)
    want = []
    for r in rows_of(texts):
        for k, it in [*enumerate(items), (0, items[0])]:
            kinds = {}
            item = [kinds.setdefault(w, len(kinds)) for w in words(it)]
            text = [kinds.get(w, -1) for w in words(r[1])][:400]
            if not item or not any(x >= 0 for x in text):
                continue
            found = plain_tiles(item, text, min(5, len(item)))
            n = sum(k for _, _, k in found)
            if n >= (len(item) if len(item) <= 12 else len(item) / 2):
                want.append((r[0], k, len(found), n, len(item)))
    assert by_row(got, "doc_id", "item_id", "n_tiles", "covered", "item_words") == sorted(want, key=repr)
    assert len({w[0] for w in want}) >= 3 * 13


def test_empty_tables(spark, documents, no_documents):
    folder = documents(ODD)
    for f in (folder, no_documents):
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{f}/benchmark.parquet")
        assert QUERIES["op6_decontaminate"](spark, f).count() == 0


def test_short_items_are_covered_whole_or_not_at_all(spark, documents):
    items = ["photosynthesis converts sunlight energy", "Tell me what is the capital of Spain today"]
    texts = ["x", "We read: Photosynthesis converts sunlight, energy! And on.", "photosynthesis converts energy of sunlight",
             "He asked what is the capital of Spain and left", "they said: tell me what is the capital of spain today, please"]
    folder = documents(texts)
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in QUERIES["op6_decontaminate"](spark, folder).collect()}
    assert got == {(1, 0): 1.0, (4, 1): 1.0}


def test_long_text(spark, documents):
    say = lambda n: " ".join(f"w{RNG.randrange(10 ** 6)}" for _ in range(n))
    item = say(40)
    folder = documents(["x", f"{say(150_000)} {item} {say(150_000)}", "same " * 300_000, say(1000)])
    spark.createDataFrame([(1, item), (2, "same same same same same same")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"], r["coverage"]) for r in QUERIES["op6_decontaminate"](spark, folder).collect()}
    assert got == {(1, 1, 1.0), (2, 2, 1.0)}
