import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from catlens.llm.files import atomic_writer
from catlens.llm.shared import KEPT, lean, scratch
from catlens.llm.token_files import ShardReader, ShardWriter, WordEncoder, encoder, from_planes, read_tokens, to_planes, write_tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t", "Hello, wörld's  it'LL\x0bdo\x1c3rd x y", "a<|endoftext|>b <|startoftext|>", "é É İstanbul ΣΑΣ", "don't we’re 12345 3.14 %%%*** a_b",
    "漢字 かな 😀👍🏽 ‍ x﻿y", "word " * 5000, "UPPER lower MiXeD" * 40, "\"", "퟿ ok",
]


def brute(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_files_equal_the_tokenizer(spark, make_docs, mode):
    rows = [(7 * i % 101, t) for i, t in enumerate(TEXTS * 3)]
    rows += [(None, "no id"), (5, "twice"), (5, "twice")]
    manifest = write_tokens(make_docs(rows), PATH, mode=mode, shards=4, block_ids=100)
    got = [tuple(r) for r in read_tokens(spark, manifest).orderBy("start").collect()]
    assert got == brute(rows)


def test_empty_table(spark, make_docs):
    assert read_tokens(spark, write_tokens(make_docs([]), PATH)).count() == 0


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_planes_and_ranges(spark, mode):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**32, 1001, dtype=np.uint32)
    assert (from_planes(to_planes(ids, mode), len(ids), mode) == ids).all()
    path = scratch(spark, "shard") + "/x.bpt"
    ids[:500] %= 70000
    with atomic_writer(path) as out:
        w = ShardWriter(out, mode, block_ids=64)
        w.add(np.array([5, 9]), np.array([400, 601]), ids)
        w.close()
    r = ShardReader(path)
    for a, n in ((0, 1001), (63, 2), (640, 361), (5, 0), (128, 64)):
        assert (r.read_ids(a, n) == ids[a : a + n]).all()
    assert [x.tolist() for x in r.documents()] == [[5, 9], [400, 601]]
    r.close()


def test_other_work_lets_go_of_the_encoder():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert encoder(path) is encoder(path)
    assert list(lean(iter([1, 2]))) == [1, 2]
    assert path not in KEPT


def test_forms_of_a_word_are_learned_once():
    words = WordEncoder(PATH)
    words.encode([" ".join(f"{w}{m}" for w in ("stone", "Stone", "STONE") for m in ("", ",", ".", "?!")).encode()])
    assert set(words._number) == {b"stone", b",", b".", b"?!"}


def test_words_cut_into_pieces_keep_their_ids(monkeypatch):
    monkeypatch.setattr("catlens.llm.token_files.CALL_WORDS", 7)
    monkeypatch.setattr("catlens.llm.token_files.LINE", 3)
    odd = ["<|endoftext|>", "<|EndOfText|>", "<|endoftext|>,", "endoftext.", "x<|startoftext|>!", "I\u0307,", "İ.", "A\u0301B;", "K:", "ΣΑΣ,", "don't,", "'S.", "it's!", "'s", "A,B.", "...", "!?!?", "\u00a0", "\u00a0,",
           "a\u00a0B", "1.", "abc123.", "X1", "ABC,,,", ",abc", ";", "wörld,", "Qqqq:", "(Quoted)", '"Yes."', "e\u0301", "\u0301", "Supercalifragilistic", "ſ,", "ﬁ.", "\x00", "a\x1cb"]
    rng = np.random.default_rng(5)
    texts = ["", *odd, *[" ".join(rng.choice(odd, 40)) for _ in range(30)], "".join(chr(c) for c in range(1, 128)), " ".join(chr(c) + "," for c in range(0x80, 0x3000) if not 0xD800 <= c < 0xE000)]
    words, tokenizer = WordEncoder(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):
        ids, lengths = words.encode([t.encode() for t in texts])
        expected = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert lengths.tolist() == [len(x) for x in expected]
        assert ids.tolist() == [i for x in expected for i in x]


def test_other_rules_keep_words_whole(tmp_path):
    rules = json.loads(Tokenizer.from_file(PATH).to_str())
    rules["normalizer"]["normalizers"] = rules["normalizer"]["normalizers"][:2]  # no lower case
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(rules))
    texts = ["Stone, stone. STONE", "stone Stone,"]
    ids, _ = WordEncoder(str(path)).encode([t.encode() for t in texts])
    assert ids.tolist() == [i for t in texts for i in [*Tokenizer.from_file(str(path)).encode(t, add_special_tokens=False).ids, 1]]
