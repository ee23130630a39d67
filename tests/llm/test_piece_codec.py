import hashlib
import random
import time

import public_tokenizers
import sentencepiece
from helpers import HARD, frame

from cohortmark.llm import piece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_codec_equals_library_on_random_texts():
    sp, c, rng = sentencepiece.SentencePieceProcessor(model_file=PATH), C.codec(PATH), random.Random(4)
    parts = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, 32000, 11)] + list("aaeell  \n\t\x00<>/=(){};▁日é") + ["\U0001f44d\U0001f3fd"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdehilnorst ") for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    texts += ["a" * 3000, " " * 700, "ab" * 900, "the" * 500, "</s><s><unk><0x0A>"]
    for t in texts:
        ids = sp.encode(t)
        assert c.encode(t) == ids
        assert c.decode(ids) == sp.decode(ids)


def test_unbroken_text_costs_in_proportion():
    sp, c, rng = sentencepiece.SentencePieceProcessor(model_file=PATH), C.codec(PATH), random.Random(5)
    text = "".join(rng.choice("thein") for _ in range(800_000))
    c.encode(text[:1000])
    took = []
    for n in (100_000, 800_000):
        began = time.process_time()
        ids = c.encode(text[:n])
        took.append(time.process_time() - began)
    assert ids == sp.encode(text)
    assert took[1] < 16 * took[0]


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 50)
    monkeypatch.setattr(C, "REMEMBERED_PAIRS", 50)
    c, sp = C.Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = " ".join(f"word{i * 7919}" for i in range(400))
    assert c.encode(text) == sp.encode(text) and len(c.chunks) <= 50 and len(c.chunks.old) <= 50


def test_chunks_side_by_side_equal_the_library(monkeypatch):
    monkeypatch.setattr(C, "AT_ONCE", 300)
    monkeypatch.setattr(C, "TEXTS_AT_ONCE", 5000)
    monkeypatch.setattr(C, "REMEMBERED", 400)
    monkeypatch.setattr(C, "MEMO_BITS", 6)
    sp, c, rng = sentencepiece.SentencePieceProcessor(model_file=PATH), C.Codec(PATH), random.Random(6)
    parts = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, 32000, 11)] + list("aaeell  \n\t\x00<>/=(){};▁日é\u0378\U00020000") + ["\U0001f44d\U0001f3fd"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdehilnorst ") for _ in range(rng.randint(0, 80))) for _ in range(1000)]
    texts += [None, "", "a", "\x00", "a" * 63, "a" * 64, "a" * 65, "日" * 40, "the" * 21, " ", " " * 64, "\u0378" * 9]
    assert list(c.encode_each(texts)) == [",".join(map(str, sp.encode(t or ""))) for t in texts]


def test_new_chunks_cost_less_side_by_side():
    c, rng = C.Codec(PATH), random.Random(7)
    chunks = list({"▁" + "".join(rng.choice(("th", "ein", "er", "a", "kon", "ung", "e", "st")) for _ in range(rng.randint(2, 5))) + str(i) for i in range(20_000)})
    took = []
    for run in (lambda: [",".join(map(str, c.ids(c.split(x)))) for x in chunks], lambda: list(c.split_each(chunks))):
        began = time.process_time()
        found = run()
        took.append(time.process_time() - began)
        assert len(took) == 1 or found == before
        before = found
    assert took[1] < 0.7 * took[0]


def test_queries_on_hard_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = sorted(map(tuple, C.digests(frame(spark), PATH).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(e := sp.encode(t or "")), sha(",".join(map(str, e))), sha(sp.decode(e))) for i, t, _, _ in HARD]
    assert got == sorted(want, key=repr)
    back = C.decode(C.encode(frame(spark), PATH), PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, sp.decode(sp.encode(t or ""))) for i, t, _, _ in HARD], key=repr)
    assert C.digests(frame(spark).limit(0), PATH).count() == 0
