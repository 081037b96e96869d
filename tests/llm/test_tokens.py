"""Token files and token alignment against plain versions that look at one whole text at a time."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyproof.llm import sequence_files, token_alignment, tokenizing
from tallyproof.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  two  spaces ", "a<|endoftext|> b <|endoftext|>", "don't we've it's", "日本 語 ▁ x", "tab\tand\x00nul", "é \U0001f600   x", "<0x41> <s> </s>", "-" * 300, "a b" * 200]


def encoded(texts, specials_as_text=False):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = specials_as_text
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_parts_give_the_ids_of_whole_texts(spark, data):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{data('0.001')}/documents.parquet").select("text").collect()] + ODD
    encoder = sequence_files._Encoder(A, 0)
    encoder.known.held = 500
    for some in (texts, texts[::-1], texts):
        assert [np.frombuffer(x, np.uint16)[:-1].tolist() for x in encoder.of(some)] == encoded(some)
    for specials in (False, True):
        _, cut = tokenizing.byte_level(A, specials)
        known = tokenizing.Remembered(tokenizing.SpacedParts(A, specials), 500)
        for some in (texts, texts[::-1], texts):
            got = [np.frombuffer(b"".join(x), np.uint32).tolist() for x in known.of([cut(t) for t in some])]
            assert got == encoded([f" {t}" for t in some], specials)
    processor, cut = tokenizing.sentence_pieces(B)
    assert [[i for p in cut(t) for i in processor.encode(p)] for t in texts] == [processor.encode(t) for t in texts]


def test_parts_are_divided_as_the_rules_do():
    assert tokenizing.divided_words("end.\nNext") == ["end", "\0.", "\nNext"]
    assert tokenizing.divided_words("a,") == ["a", "\0,"] and tokenizing.divided_words("a),") == ["a),"]
    for part in ("a\n", "\na", "a\n\nb", "a \nb", "a\r\nb"):
        assert tokenizing.divided_words(part) == [part]
    parts = ["end.\nNext,", "don't.\nI've", "x1.\n2y;", "É.\nÈ", "word", "ªº", "²³", "l\u0301ma", "<|endoftext|>.\nq", "\u2028x", "a\x0bb."]
    pieces = [tokenizing.divided_words(p) for p in parts]
    for specials in (False, True):
        got = [np.frombuffer(b"".join(x), np.uint32).tolist() for x in tokenizing.Remembered(tokenizing.SpacedParts(A, specials, pieces=True)).of(pieces)]
        assert got == encoded([f" {p}" for p in parts], specials)


def test_texts_are_cut_at_single_spaces_between_visible_characters():
    for text in ODD + ["a b c", " a b", "a  b c", "a \n b c", "a b ", "é à\u00a0b c", "x\u0301 y z"]:
        parts = tokenizing.parts_of(text)
        assert " ".join(parts) == text
    assert tokenizing.parts_of("a b  c\td e ") == ["a", "b  c\td", "e "]


def test_a_tokenizer_that_sees_more_is_given_whole_texts(tmp_path):
    told = json.loads(Tokenizer.from_file(A).to_str())
    told["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    assert tokenizing.byte_level(str(path), False)[1]("a b") == ["a b"]
    tokenizing.byte_level.cache_clear()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected_files(rows):
    start, out = 0, []
    for doc, ids in rows:
        out.append((doc, start, len(ids) + 1, crc([*ids, 0])))
        start += len(ids) + 1
    return out


def test_files_of_the_supplied_documents(spark, data):
    folder = data("0.001")
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    want = expected_files(zip([d for d, _ in rows], encoded([t for _, t in rows]), strict=True))
    assert [tuple(r) for r in QUERIES["op12_arrow_sequences"](spark, folder).orderBy("start").collect()] == want


def test_awkward_files(spark, awkward, tmp_path):
    more = spark.createDataFrame([(100 + k, t, "x", "y", 1) for k, t in enumerate(ODD)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    sequence_files.write_sequences(docs, f"{tmp_path}/f", A, length=64, shard_bytes=20_000)
    got = sequence_files.read_documents(spark, f"file://{tmp_path}/f").orderBy("start").collect()
    rows = docs.select("doc_id", "text").collect()
    ids = {t: x for t, x in zip([r["text"] for r in rows], encoded([r["text"] or "" for r in rows]), strict=True)}
    assert [r["doc_id"] for r in got] == sorted([r["doc_id"] for r in rows], key=lambda d: (d is not None, d))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((r["doc_id"], len(ids[r["text"]]) + 1, crc([*ids[r["text"]], 0])) for r in rows)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()


def test_sequences_are_views_of_the_file(spark, awkward, tmp_path):
    manifest = sequence_files.write_sequences(awkward, f"{tmp_path}/f", A, length=64, shard_bytes=1 << 30).collect()
    for shard in manifest:
        file = sequence_files.SequenceFile(f"{tmp_path}/f/{shard['sequences']}")
        flat = np.concatenate([file[k][0] for k in range(len(file))])
        mask = np.concatenate([file[k][1].to_numpy(zero_copy_only=False) for k in range(len(file))])
        assert mask.sum() == shard["n_ids"] and mask[: shard["n_ids"]].all() and len(mask) - mask.sum() < 64
        before = pa.total_allocated_bytes()
        ids, bits = file[len(file) // 2]
        assert len(ids) == len(bits) == 64 and not ids.flags.owndata and pa.total_allocated_bytes() == before
        assert flat.dtype == np.uint16
        with pytest.raises(IndexError):
            file[len(file)]


def test_files_of_tasks_that_did_not_count_are_not_read(spark, awkward, tmp_path):
    folder = f"{tmp_path}/f"
    sequence_files.write_sequences(awkward, folder, A, length=64)
    before = sequence_files.read_documents(spark, folder).count()
    shard = sequence_files._Shard(folder, 0, 64, np.dtype(np.uint16))
    shard.add(pa.array([5]), np.array([3]), np.array([1, 2, 0], np.uint16))
    shard.close()
    assert sequence_files.read_documents(spark, folder).count() == before == awkward.count()


def test_no_documents(spark, awkward, tmp_path):
    sequence_files.write_sequences(awkward.where("false"), f"{tmp_path}/f", A)
    assert sequence_files.read_documents(spark, f"{tmp_path}/f").count() == 0
    assert token_alignment.align_documents(awkward.where("false"), A, B).count() == 0


def plain_alignment(texts):
    """Measures by position of each text, with sets and loops over bytes."""
    processor = sentencepiece.SentencePieceProcessor(model_file=B)
    of = tokenizing.byte_alphabet()
    tokenizer = Tokenizer.from_file(A)

    def bytes_b(i):
        piece = processor.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()

    found, pairs = [], Counter()
    for text, a in zip(texts, encoded([f" {t or ''}" for t in texts], True), strict=True):
        b = processor.encode(text or "")
        spelt_a, spelt_b = [bytes(of[c] for c in tokenizer.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        if not text or not b"".join(spelt_a) == b"".join(spelt_b) == f" {text}".encode():
            found.append(None)
            continue
        at_a, at_b = ([k for k, x in enumerate(side) for _ in x] for side in (spelt_a, spelt_b))
        links = sorted(set(zip(at_a, at_b, strict=True)))
        pairs.update((a[i], b[j]) for i, j in links)
        groups, held = [], ([], [])
        for k, (i, j) in enumerate(zip(at_a, at_b, strict=True)):
            last = k + 1 == len(at_a)
            ends = [last or at_a[k + 1] != i, last or at_b[k + 1] != j]
            for side, x, end in ((0, a[i], ends[0]), (1, b[j], ends[1])):
                if end:
                    held[side].append(str(x))
            if all(ends):
                groups.append("|".join(",".join(side) for side in held))
                held = ([], [])
        found.append((a, b, links, groups))
    top = Counter()
    for (_, b), n in pairs.items():
        top[b] = max(top[b], n)
    out = []
    for x in found:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = x
        counts = [(pairs[a[i], b[j]], top[b[j]]) for i, j in links]
        out.append((len(a), len(b), len(groups), len(links), sum(n == t for n, t in counts), sum(n for n, _ in counts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def compare(docs, got):
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r["doc_id"], *m) for r, m in zip(rows, plain_alignment([r["text"] for r in rows]), strict=True))
    assert Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in got.collect()) == want


def test_alignment_of_the_supplied_documents(spark, data):
    folder = data("0.001")
    compare(spark.read.parquet(f"{folder}/documents.parquet"), QUERIES["op11_token_alignment"](spark, folder))


def test_awkward_alignment(spark, awkward):
    more = spark.createDataFrame([(100 + k, t, "x", "y", 1) for k, t in enumerate(ODD)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    compare(docs, token_alignment.align_documents(docs, A, B))


def test_texts_in_small_blocks_have_the_same_counts(spark, data):
    docs = spark.read.parquet(f"{data('0.001')}/documents.parquet")
    counts = [sorted(map(tuple, token_alignment.pair_counts(token_alignment.aligned_blocks(docs, A, B, size)).collect())) for size in (1 << 10, 8 << 20)]
    assert counts[0] == counts[1]


def test_known_parts_are_looked_up_once():
    """Of parts that a worker knows, one look is enough; what became None is not asked for again."""
    looked, asked = [], []

    class Part(str):
        def __hash__(self):
            looked.append(str(self))
            return super().__hash__()

        __eq__ = str.__eq__

    known = tokenizing.Remembered(lambda parts: asked.extend(parts) or [None if p == "b" else p.upper() for p in parts], 10)
    assert known.of([["a", "b", "a"], [], ["c"]]) == [["A", None, "A"], [], ["C"]] and sorted(asked) == ["a", "b", "c"]
    assert known.of([[Part("a"), Part("c"), Part("a")], [Part("b")]]) == [["A", "C", "A"], [None]]
    assert sorted(asked) == ["a", "b", "c"] and looked.count("a") == 2 and looked.count("c") == 1


def test_pieces_give_the_ids_of_whole_texts():
    """Texts of characters that stand oddly around spaces, line ends and marks, also where Arrow's texts begin and end inside a buffer."""
    rng = random.Random(3)
    alphabet = [" "] * 9 + ["\n"] * 4 + [*"abYZ019_.,;:!?'-<|>\t\r\0\x1f\x7f", "é", "ß", "\u0301", "\u00a0", "\u0085", "\u2028", "\u200b", "日", "ª", "²", "\U0001f600", "\U0001d7d8", "\U00020000", "\ufffd", " the", "'s", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(5000)] + ODD
    encoder = sequence_files._Encoder(A, 0)
    want = encoded(texts)
    assert [np.frombuffer(x, np.uint16)[:-1].tolist() for x in encoder.of(texts)] == want
    with_nulls = pa.array([None, *texts, None], pa.string())
    for some, ids in ((with_nulls, [[], *want, []]), (with_nulls[1:-1].slice(700, 900), want[700:1600]), (with_nulls[:1], [[]]), (with_nulls.cast(pa.large_string())[3:9], want[2:8])):
        sizes, flat = encoder.flat(some)
        assert sizes.tolist() == [len(x) + 1 for x in ids] and flat.tolist() == [i for x in ids for i in [*x, 0]]
    parts = [t.encode() for t in ("", "Ab ", "cé, dé e.\nf. 日 g.", "h i\n")]
    data, starts = b"".join(parts), np.cumsum([0, *map(len, parts)])
    begins = tokenizing.piece_begins(np.frombuffer(data, np.uint8), starts)
    assert [data[i:j].decode() for i, j in zip(begins[:-1], begins[1:], strict=True)] == ["Ab ", "cé,", " dé", " e", ".", "\nf", ".", " 日", " g.", "h", " i\n"]


def test_a_tokenizer_that_sees_more_encodes_whole_texts(tmp_path):
    told = json.loads(Tokenizer.from_file(A).to_str())
    told["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    texts = ["a b", "", None, "b\nc, d", "a b"]
    plain = Tokenizer.from_file(str(path))
    got = [np.frombuffer(x, np.uint16).tolist() for x in sequence_files._Encoder(str(path), 0).of(texts)]
    assert got == [[*plain.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    tokenizing.byte_level.cache_clear()


def test_only_distinct_pieces_become_python_objects(monkeypatch):
    encoder, asked = sequence_files._Encoder(A, 0), []
    look = encoder.known.of
    monkeypatch.setattr(encoder.known, "of", lambda texts: asked.extend(p for parts in texts for p in parts) or look(texts))
    encoder.of(["one two, two.\nThree two " * 50, "two two"] * 20)
    assert len(asked) == len(set(asked)) < 12
