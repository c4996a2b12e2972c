from helpers import edge_docs, edge_rows, no_docs, prose

from herald.llm import token_counts as T


def library_counts(texts, name="byte_bpe_50k.json"):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.tokenizer_file(name))
    return [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(spark):
    rows = edge_rows()
    texts = [r[1] or "" for r in rows]
    want = sorted(((r[0], len(t.encode()), n, n > 1024) for r, t, n in
                   zip(rows, texts, library_counts(texts))), key=repr)
    got = T.token_counts(edge_docs(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[3] for w in want) and not all(w[3] for w in want)


def test_special_strings_and_small_batches(spark, monkeypatch):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "  two  blanks  ", "tabs\t\tand\nlines\n", "don't 'tis we'll"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(df).collect()}
    assert [got[i] for i in range(len(texts))] == library_counts(texts)


def test_parts_add_up_to_the_whole(monkeypatch):
    texts = [prose(4000, 3), "x" * 5000, ("word  " * 900) + ("a b" * 900), "line\n" * 1000 + prose(500, 1),
             "it's we'll " * 700, "<|endoftext|> a b " * 300, " <|endoftext|> <|endoftext|>", "é è ☃ 漢 字 1 2 \u0301 x",
             "a\u00a0 b \u00a0c \x85 d \x1c e \u200b f", "! ? ... 's 'll x 's", "", " ", "  a", "a  ", "\n a \n b"]
    want = library_counts(texts)
    count = T.load_counter("byte_bpe_50k.json", True)
    assert count(texts) == want and count(texts[::-1]) == want[::-1]
    assert len(T.SAFE.split(texts[0])) > 3000 and T.SAFE.split(texts[2])[0] == "word  word  word"[:4] + "  word" * 899 + "  a"
    monkeypatch.setattr(T, "MEMO_PARTS", 3)
    monkeypatch.setattr(T, "MEMO_CHARS", 2)
    monkeypatch.setattr(T, "BATCH_BYTES", 10)
    assert [count([t])[0] for t in texts] == want


def test_sentencepiece_model(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=T.tokenizer_file("piece_bpe_32k.model"))
    rows = [r for r in edge_rows() if r[0] in (1, 7, 8, 9)]
    got = {r.doc_id: r.n_tokens for r in T.token_counts(edge_docs(spark), tokenizer="piece_bpe_32k.model").collect()}
    for r in rows:
        assert got[r[0]] == len(sp.encode(r[1]))


def test_empty_table(spark):
    assert T.token_counts(no_docs(spark)).count() == 0
