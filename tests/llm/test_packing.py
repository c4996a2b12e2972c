import zlib
from collections import defaultdict

import numpy as np
from helpers import edge_docs, edge_rows, no_docs, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from herald.llm import packing
from herald.llm.packing import WordEncoder, cut, differencing, pack_batch, pack_documents
from herald.llm.token_counts import tokenizer_file

ODD = ["", "İİ J̌ ǰ Ḱ", "it's THE 'sound, o'clock. ΑΣ, ΣΑΣ", "<|endoftext|> <|ENDOFTEXT|>, x<|endoftext|>.",
       "a b\x85c\x1cd . , ..,", "Ünïcödé ſt ŉ Ŀ 漢字,かな。 é, É.\tx,\n", "½ ² ٣ 12,345. 3.14, v1.\x0bend.",
       "word., word,. end.,\n", "Ǆ ﬁ ﬀ, ＡＢＣ.", "x" * 5000 + ".", "$$$ %%% word$$$ a@b.c, |"]


def ids_of(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    return [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def test_word_memo_equals_the_library():
    texts = ODD + [t or "" for _, t, *_ in edge_rows()]
    encoder = WordEncoder("word_bpe_49k.json")
    for _ in range(2):
        assert encoder.encode([t.encode() for t in texts]) == ids_of(texts)


def test_memo_is_bounded_and_keeps_frequent_words(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 50)
    encoder, learned = WordEncoder("word_bpe_49k.json"), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: (learned.extend(words), learn(words)))
    for i in range(40):
        texts = [f"often {' '.join(f'w{i}x{j}' for j in range(20))}"]
        assert encoder.encode([t.encode() for t in texts]) == ids_of(texts)
        assert len(encoder.memo) + len(encoder.older) < 250
    assert learned.count(b"often") == 1


def test_a_word_is_looked_up_once_for_all_its_places():
    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    encoder = WordEncoder("word_bpe_49k.json")
    encoder.memo = Counted()
    texts = ["often met, " * 2000, "", " met often\n" * 1000]
    assert encoder.encode([t.encode() for t in texts]) == ids_of(texts)
    assert Counted.asked < 30
    assert encoder.encode([b"", b" \n"]) == [b"", b""] and encoder.encode([]) == []


def test_letters_go_to_the_model_only_if_it_gives_the_library_s_ids(tmp_path, monkeypatch):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    texts = [*ODD, "one Word twice word, unmet ünmet"]
    split = WordEncoder("word_bpe_49k.json")
    encode, whole = split._encode, []
    monkeypatch.setattr(split, "_encode", lambda words: (whole.extend(words), encode(words))[1])
    assert split.encode([t.encode() for t in texts]) == ids_of(texts)
    assert split._direct and "unmet" not in whole and "ünmet" not in whole
    # characters stand for themselves here, and words are begun with a mark
    tok = Tokenizer(models.BPE({c: i for i, c in enumerate("▁onewrdtic,umü?")}, [], unk_token="?"))
    tok.normalizer = normalizers.Lowercase()
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Whitespace(), pre_tokenizers.Metaspace()])
    tok.save(str(tmp_path / "other.json"))
    monkeypatch.setattr(packing, "tokenizer_file", lambda name: str(tmp_path / name))
    other = WordEncoder("other.json")
    want = [np.array(tok.encode(texts[-1]).ids, dtype="<u4").tobytes()]
    assert not other._direct and other.encode([texts[-1].encode()]) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé.,'’ \n<|>İ́̌1½s"), max_size=30))
def test_word_memo_equals_the_library_on_random_text(text):
    test_word_memo_equals_the_library.encoder = getattr(
        test_word_memo_equals_the_library, "encoder", None) or WordEncoder("word_bpe_49k.json")
    assert test_word_memo_equals_the_library.encoder.encode([text.encode()]) == ids_of([text])


def check(rows, pieces, capacity=4096):
    """Every id in exactly one piece, checksums right, sequences gapless and never overfull."""
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(ids_of([t or ""])[0] + b"\x02\0\0\0")
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        expect = sorted((s, n, zlib.crc32(t[4 * s:4 * (s + n)]), len(t) // 4)
                        for t in texts for s, n in cut(len(t) // 4, capacity, 1024))
        assert sorted(by_doc[i]) == expect
        assert sum(n for _, n, *_ in expect) == sum(len(t) // 4 for t in texts)
    return sequences


def test_awkward_rows(spark):
    got = pack_documents(edge_docs(spark)).collect()
    check([r[:2] for r in edge_rows()], got)
    assert pack_documents(no_docs(spark)).count() == 0


def test_little_padding_in_several_batches(spark):
    rows = [(i, prose(30 + (i * 97) % 900, i)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sequences = check(rows, pack_documents(df, batch_windows=40).collect())
    used = sum(n for spans in sequences.values() for _, n in spans)
    assert used / (4096 * len(sequences)) > 0.95


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1024), min_size=1, max_size=120), st.integers(1, 9))
def test_differencing_is_a_partition(sizes, k):
    window = differencing(np.array(sizes), k)
    assert len(window) == len(sizes) and window.min() >= 0 and window.max() < k
    window = pack_batch(np.array(sizes), 1024)
    assert np.bincount(window, weights=sizes).max() <= 1024


def test_differencing_beats_greedy_spread():
    sizes = np.array([8, 7, 6, 5, 4])
    sums = np.bincount(differencing(sizes, 2), weights=sizes)
    assert abs(sums[0] - sums[1]) == 2  # the known Karmarkar-Karp result; greedy gives 4


def test_cut_covers():
    for n in (1, 1024, 1025, 4095, 4096, 4097, 10000):
        pieces = cut(n, 4096, 1024)
        assert [s for s, _ in pieces] == [sum(x for _, x in pieces[:i]) for i in range(len(pieces))]
        assert sum(x for _, x in pieces) == n and min(x for _, x in pieces) >= 1
