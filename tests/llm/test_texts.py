"""Operators that read one text at a time, and SimHash, against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from eventflow.llm import pii, simhash
from eventflow.llm.queries import QUERIES
from tests.llm.conftest import rows_of

RNG = random.Random(7)
WORDS = [f"w{i}" for i in range(60)]
PROSE = [" ".join(RNG.choices(WORDS, k=RNG.randint(1, 60))) for _ in range(30)]
ODD = [None, "", " ", "\n\n", "▁ x", "a", "A b\tC\x0bd  e", "é É ﬁ 日本 \U0001F600", " ", "x" * 5000,
       " ".join(["again"] * 9000), "a\x00b", "a  b   ", "  lead", "tail  ", "a_b1c  2.50$$$", "<s> </s> <0x0A>"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_op8_equals_library(spark, documents):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ODD + PROSE + ["".join(RNG.choices("abc .,▁\n é日1$", k=RNG.randint(1, 80))) for _ in range(300)]
    got = QUERIES["op8_sentence_pieces"](spark, documents(texts))
    want = []
    for r in rows_of(texts):
        ids = sp.encode(r[1] or "")
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    assert by_row(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_op8_long_segment_uses_a_heap_with_the_same_result():
    import public_tokenizers
    from eventflow.llm.sentence_pieces import vocabulary
    v = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for k in range(200):
        s = "▁" + "".join(RNG.choices("etaoinshr", k=RNG.randint(1, 22)))
        assert v.encode_segment(s) == v.merge_short([s])[0]


def test_op8_memo_stays_bounded_over_odd_texts(monkeypatch):
    import public_tokenizers
    import sentencepiece
    from eventflow.llm import sentence_pieces
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp, v = sentencepiece.SentencePieceProcessor(model_file=model), sentence_pieces.MergeVocabulary(model)
    monkeypatch.setattr(sentence_pieces, "MEMO_SEGMENTS", 50)
    rng = random.Random(8)
    for _ in range(20):
        many = ["  " + "  ".join("".join(rng.choices("etaoinshr", k=6)) for _ in range(10)) for _ in range(5)]
        assert v.encode_texts(many)[1] == [",".join(map(str, sp.encode(t))) for t in many]
        assert len(v.by_segment) <= 50


def test_op8_frequent_segments_are_encoded_once_and_many_at_a_time(monkeypatch):
    import public_tokenizers
    from eventflow.llm import sentence_pieces
    v = sentence_pieces.MergeVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(sentence_pieces, "MEMO_SEGMENTS", 200)
    monkeypatch.setattr(sentence_pieces, "MEMO_WORDS", 200)
    rng, learned, calls, learn = random.Random(9), [], [], v.learn
    monkeypatch.setattr(v, "learn", lambda segments: (calls.append(1), learned.extend(segments), learn(segments)))
    often, rounds = ["again", "and", "Zq xj", "é日"], 60
    for _ in range(rounds):
        rare = ["".join(rng.choices("etaoinshr", k=9)) for _ in range(40)]
        many = [" ".join(often + rare[:20]), "  ".join(rare[20:]) + "  "]
        assert v.encode_texts(many)[1] == [",".join(map(str, v.library.encode(t))) for t in many]
        assert len(v.by_segment) <= 200 and len(v.by_word) <= 200
    assert learned.count("▁again") == learned.count("▁and") == learned.count("▁Zq") == learned.count("▁é日") == 1
    assert len(calls) == rounds  # texts with runs of spaces are learned along with the others


def test_op8_wrong_ids_raise(monkeypatch):
    import public_tokenizers
    from eventflow.llm import sentence_pieces
    model = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(10)
    words = ["".join(rng.choices("etaoinshr", k=6)) for _ in range(100)]
    for wrong in ("▁the", ".)", "é日", "▁▁▁"):  # with and without a space in front, with byte ids, spaces alone
        for split in (False, True):  # other ids of the same text; ids of another text
            v = sentence_pieces.MergeVocabulary(model)
            right = v.encode_segments

            def other(segments):
                flat, count = right(segments)
                if wrong not in segments:
                    return flat, count
                k = segments.index(wrong)
                rows = [r.tolist() for r in np.split(flat, np.cumsum(count)[:-1])]
                rows[k] = [v.byte_ids[b] for b in wrong.replace("▁", " ").encode()] if split else rows[k] + [v.ids["t"]]
                return (np.array([i for r in rows for i in r], "int32"),
                        np.array([len(r) for r in rows]))
            monkeypatch.setattr(v, "encode_segments", other)
            with pytest.raises(ValueError, match="differ|decodes"):
                v.learn({wrong, *("▁" + w for w in words), "a", ",,"})


def test_op8_decodes_each_text_from_its_ids():
    import public_tokenizers
    from eventflow.llm import sentence_pieces
    v = sentence_pieces.MergeVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    many = ["a tale", "", "a  tale ", "▁é日 a\x00", "tale"]
    assert v.encode_texts(many)[2] == ["a tale", "", "a  tale ", " é日 a\x00", "tale"]
    v.by_word.young["tale"] = v.by_word.young["a"]  # other ids: what is decoded is them, not the text that came in
    counts, ids, decoded = v.encode_texts(many)
    assert decoded == [v.library.decode([int(i) for i in x.split(",") if x]) for x in ids]
    assert decoded[0] == "a a" and decoded[4] == "a" and counts[0] == 2 * counts[4]


def spans_by_regex(text):
    out = {}
    out["email"] = [m.span() for m in re.finditer(pii.EMAIL, text)]
    out["ip"] = [m.span() for m in re.finditer(pii.IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    cards = []
    for m in re.finditer(pii.CARD, text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        s = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and s % 10 == 0:
            cards.append(m.span())
    out["card"] = cards
    out["phone"] = [m.span() for m in re.finditer(pii.PHONE, text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return out


def test_op9_equals_patterns(spark, documents):
    known = ["mail x.y@a-b.example.com, 1.2.3.4 and 4111 1111 1111 1111 or +1 (988) 555-2485.", "a@b.c@d.e", "é@x.y 999.1.1.1",
             "1.2.3.4.5.6.7.8.9", "4111-1111-1111-1111 5 4111111111111111", "+1+12 345 678 90", "@", "+", "a@", "1.2.3", "+49 (0) 30-12-45-78 ((("]
    mixed = ["".join(RNG.choices("aZ@.+-0123456789 (.)%é\n", k=RNG.randint(1, 90))) for _ in range(1500)]
    digits = ["".join(RNG.choices("4111 -", k=RNG.randint(10, 40))) for _ in range(800)]
    texts = ODD + known + mixed + digits
    got = QUERIES["op9_pii"](spark, documents(texts))
    want = []
    for r in rows_of(texts):
        f = spans_by_regex(r[1] or "")
        base = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in f[k])
        want.append((r[0], *(len(f[k]) for k in ("email", "ip", "card", "phone")), sha(base)))
    assert by_row(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)


def test_op9_digit_chain_beyond_the_digit_limit():
    zeros = "0" * 5000
    assert pii.parse_ips(f"{zeros}.1.2.{zeros}7", 0) == ([(0, 10006)], 10006)
    assert pii.parse_ips(f"{zeros}256.1.2.3", 0) == ([], 5009)


def test_op9_own_kinds():
    f = pii.find_spans("IBAN: DE89 3704 0044 0532 0130 00, Account no. 12345678; see https://me:pw@host.org/x")
    assert f["account"] == [(6, 33), (47, 55)] and f["login"] == [(69, 74)]
    assert pii.redact("x DE89370400440532013000 y a@b.co", pii.find_spans("x DE89370400440532013000 y a@b.co")) == "x [ACCOUNT] y [EMAIL]"


def plain_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    n = len(words)
    shingles = [" ".join(words[i:i + 4]) for i in range(n - 3)] if n >= 4 else [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_op3_equals_brute_force(spark, documents):
    base = [" ".join(RNG.choices(WORDS, k=300)) for _ in range(4)]
    near = []
    for b in base:
        for _ in range(12):
            w = b.split()
            w[RNG.randrange(len(w))] = "edit"
            b = " ".join(w)
            near.append(b)
    texts = ODD + PROSE[:5] + base + near + ["one two", "One  two", base[0].upper()]
    got = QUERIES["op3_simhash"](spark, documents(texts))
    rows = rows_of(texts)
    fps = [plain_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(((r[0], f"{f:016x}", least.get(g)) for r, f, g in zip(rows, fps, group)), key=repr)
    assert len({w[2] for w in want}) < len(want) - 20
    assert by_row(got, "doc_id", "fingerprint", "component_id") == want


def test_op3_cells_are_not_broadcast(spark):
    # Spark sizes the cells like the few fingerprints they are made from, and these as small enough for the driver
    rng = random.Random(11)
    fps = [rng.getrandbits(63) for _ in range(300)]
    fps += [f ^ 1 << rng.randrange(63) ^ 1 << rng.randrange(63) for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in set(fps)], "fp long"))
    found = {(r["u"], r["v"]) for r in got.collect()}
    assert found == {(u, v) for u in set(fps) for v in set(fps) if u < v and (u ^ v).bit_count() <= 4} and len(found) > 200
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastExchange" not in plan and re.search(r"SortMergeJoin(\(skew=true\))? \[cell#", plan)


@pytest.mark.parametrize("name", ["op3_simhash", "op8_sentence_pieces", "op9_pii"])
def test_empty_table(spark, no_documents, name):
    assert QUERIES[name](spark, no_documents).count() == 0


def test_op3_long_texts(spark, documents):
    long = " ".join(RNG.choices(WORDS, k=400_000))
    got = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, documents(["x", long, long + " end", "again " * 200_000, "again " * 9])).collect()}
    assert got[1]["component_id"] == got[2]["component_id"] == 1 and got[3]["component_id"] == got[4]["component_id"] == 3
    # the fingerprint by definition, from counts of the distinct shingles
    words, votes = long.split(), {}
    for k in range(len(words) - 3):
        votes[" ".join(words[k:k + 4])] = votes.get(" ".join(words[k:k + 4]), 0) + 1
    bits = [0] * 64
    for s, n in votes.items():
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            bits[b] += n * (h >> b & 1)
    assert got[1]["fingerprint"] == f"{sum(1 << b for b in range(64) if 2 * bits[b] > len(words) - 3):016x}"
