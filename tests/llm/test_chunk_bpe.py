import hashlib
import json
import random

import public_tokenizers
import pytest
from llm_samples import EDGE, documents, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from aforo.llm import chunk_bpe
from aforo.llm.common import unpack_ints

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def digests(text):
    ids = ids_of(text)
    decoded = WHOLE.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def mixture(seed, n):
    """Text of words, runs of blanks, quotes, digits, other scripts, special tokens and long runs."""
    r = random.Random(seed)
    parts = ["word", " ", "  ", "\n", "\n\n ", "\t", "'re", "don't", "'", "1234", "ü", "中文字", "é" * 5, "<|endoftext|>",
             "<|endof", "text|>", " <|endoftext|> ", "!!", " ", "　", "\x1c", "x" * 300, "🙂", "\r\n", " a b c d e "]
    return "".join(r.choice(parts) + r.choice(["", " ", "a"]) for _ in range(n))


def encoded(texts, codec=None):
    """The ids of texts by their chunks alone, without Spark."""
    codec = codec or chunk_bpe.Codec(PATH)
    cut = [chunk_bpe.chunks(t.encode()) for t in texts]
    known = {c: chunk_bpe._Chunk(c, ids, codec.pieces) for cs in cut for c, ids in zip(cs, codec.encode(cs))}
    return listed(chunk_bpe.assembled([[known[c] for c in cs] for cs in cut], codec))


def listed(found):
    return [memoryview(ids).cast("I").tolist() for ids in found]


def test_joins_are_repaired():
    texts = [mixture(i, 40 * (i % 30)) for i in range(300)] + [prose(i, 3000) for i in range(10)]
    assert encoded(texts) == [ids_of(t) for t in texts]


def test_disagreeing_chunks_are_swallowed():
    """Chunks whose stored ids are wrong at the ends never reach the result; the whole text is the last resort."""
    codec, texts = chunk_bpe.Codec(PATH), [prose(i, 2000) for i in range(5)]
    for step in (1, 2, 3):
        documents_ = []
        for t in texts:
            cut = chunk_bpe.chunks(t.encode())
            made = [chunk_bpe._Chunk(c, ids, codec.pieces) for c, ids in zip(cut, codec.encode(cut))]
            for chunk in made[1::step]:
                if chunk.head:
                    a, b, c, d = *chunk.head[2:], *chunk.tail[2:]
                    chunk.ids = chunk.ids[:a] + bytes(b - a) + chunk.ids[b:c] + bytes(d - c) + chunk.ids[d:]
            documents_.append(made)
        assert listed(chunk_bpe.assembled(documents_, codec)) == [ids_of(t) for t in texts]


def test_chunks_follow_content():
    body = prose(9, 5000).encode()
    a, b = chunk_bpe.chunks(body), chunk_bpe.chunks(prose(8, 77).encode() + b" " + body)
    assert b"".join(a) == body and all(chunk_bpe.LEAST <= len(c) <= chunk_bpe.MOST + 3 for c in a[:-1])
    assert len(set(a) & set(b)) > 0.9 * len(a)
    for raw in (b"", b"\xff\xfe" * 400, "中".encode() * 9000, b" " * 20_000):
        assert b"".join(chunk_bpe.chunks(raw)) == raw.decode("utf-8", "replace").encode()
        for chunk in chunk_bpe.chunks(raw):
            chunk.decode()


def test_pieces_are_the_vocabulary():
    codec = chunk_bpe.Codec(PATH)
    assert b"".join(codec.pieces[i] for i in ids_of("aé中 \n<|endoftext|>\x00")) == "aé中 \n<|endoftext|>\x00".encode()


@pytest.mark.parametrize("digest", [True, False])
def test_edge_rows(spark, documents, digest, monkeypatch):  # noqa: F811
    long, passage = prose(31, 20_000), prose(32, 900)
    rows = [*EDGE, (20, mixture(3, 400)), (21, long), (22, long), (23, passage + " x " + long), (None, passage + "'re"), (24, passage)]
    monkeypatch.setattr(chunk_bpe, "BLOCK_BYTES", 40_000)
    frame = documents(rows).repartition(3, F.length("text"))
    frame.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/bpe-{digest}")
    out = chunk_bpe.encode(spark.read.parquet(path), chunk_bpe.Codec(PATH), digest=digest).collect()
    if digest:
        assert sorted((tuple(r) for r in out), key=repr) == sorted(((k, *digests(t)) for k, t in rows), key=repr)
    else:
        got = sorted(((r["doc_id"], unpack_ints(r["ids"]).tolist(), bytes(r["decoded"])) for r in out), key=repr)
        assert got == sorted(((k, ids_of(t), (t or "").encode()) for k, t in rows), key=repr)
        assert all(r["n_tokens"] == len(unpack_ints(r["ids"])) for r in out)


def test_shared_chunks_are_encoded_by_one_block(spark, documents, monkeypatch):  # noqa: F811
    """Twelve blocks hold one long text; the first of them encodes its chunks, the others get the ids."""
    text = prose(40, 8000)
    monkeypatch.setattr(chunk_bpe, "BLOCK_BYTES", 1000)
    seen = []
    table = chunk_bpe.Staging.table

    def kept(self, df, part):
        out = table(self, df, part)
        if part == "parts":
            seen.extend(out.where("kind = 1").groupBy("digest").count().collect())
        return out

    monkeypatch.setattr(chunk_bpe.Staging, "table", kept)
    frame = documents([(i, text) for i in range(12)])
    out = chunk_bpe.encode(frame, chunk_bpe.Codec(PATH), digest=True).collect()
    assert {tuple(r)[1:] for r in out} == {digests(text)} and len(out) == 12
    assert len(seen) == len(set(chunk_bpe.chunks(text.encode()))) and all(r["count"] == 1 for r in seen)


def test_empty_table(spark, documents):  # noqa: F811
    assert chunk_bpe.encode(documents(EDGE).limit(0), chunk_bpe.Codec(PATH), digest=True).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        chunk_bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = contract.queries()["op13_chunk_bpe"](spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == sorted((k, *digests(t)) for k, t in docs)


def test_the_quicker_encoder_gives_the_same_ids():
    codec = chunk_bpe.Codec(PATH)
    assert codec.same_merges
    around = ["{}", "a{}b", " {} ", "1{}{}2", "!{}!", "  {}", "{}\n{} x", "'{}", "{}'s", "\u00e9{}\u00fc", "{}\t{}"]
    texts = [shape.replace("{}", chr(c)) for c in range(0x250) for shape in around] + [mixture(2000 + i, 60) for i in range(300)]
    plain = [t for t in texts if not codec.unplain.search(t)]
    assert len(plain) >= 0x250 * len(around)
    assert listed(codec.encode([t.encode() for t in texts])) == [ids_of(t) for t in texts]
    codec.same_merges = False
    assert listed(codec.encode([t.encode() for t in texts])) == [ids_of(t) for t in texts]


def test_merges_that_ids_do_not_tell_are_noticed():
    parts = json.loads(WHOLE.to_str())
    assert chunk_bpe.same_merges(WHOLE, parts)
    swapped = parts["model"]["merges"]
    swapped[100], swapped[200] = swapped[200], swapped[100]
    assert not chunk_bpe.same_merges(Tokenizer.from_str(json.dumps(parts)), parts)
