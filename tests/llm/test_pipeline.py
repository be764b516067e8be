import hashlib
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from test_filters import serial_matches, serial_statistics
from test_near_duplicates import groups, near, serial_fingerprint, serial_lines

from lociweave.llm import byte_bpe, quality
from lociweave.llm.tables import read

FOLDER = "/root/testdata/sf0.001"


def serial_features(text):
    n, chars, symbols, dup, inside = serial_statistics(text)
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    share = lambda a, b: a / b if b else 0.0
    marks = sum(not (c.isalnum() or c.isspace()) for c in text)
    values = {
        "words": n, "word_length": share(chars, n), "symbol_share": share(symbols, chars), "mark_share": share(marks, chars),
        "upper_share": share(sum(c.isupper() for c in text), chars), "dup_line_share": share(dup, len(lines)), "repeat_share": share(inside, n),
        "distinct_share": share(len(set(words)), n),
    }
    return values, n < 50 or 100 * inside > 50 * n


def serial_pipeline(spark):
    docs = {r.doc_id: r.text for r in read(spark, FOLDER, "documents").collect()}
    rules = quality.learn(quality.with_statistics(read(spark, FOLDER, "documents")), read(spark, FOLDER, "labels"))
    passed = {}
    for i, text in docs.items():
        values, failed = serial_features(text)
        if not failed and not any(all((values[c.feature] > c.threshold) == c.above for c in rule) for rule in rules):
            passed[i] = text
    lines = {key[0]: text for key, text in serial_lines([(i, t, 0) for i, t in passed.items()]).items()}
    ids = sorted(lines)
    root = groups(len(ids), near([serial_fingerprint(lines[i]) for i in ids]))
    first = {}
    for i, r in zip(ids, root):
        first.setdefault(r, i)
    items = [(r.item_id, r.text) for r in read(spark, FOLDER, "benchmark").collect()]
    bad = {m[0] for m in serial_matches([(i, lines[i]) for i in first.values()], items)}
    codec = byte_bpe.Codec(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    out = {}
    for i in first.values():
        if i not in bad:
            ids_bytes = np.array(codec.encoder.encode_ordinary(lines[i]), "<u4").tobytes()
            out[i] = (len(ids_bytes) // 4, hashlib.sha256(ids_bytes).hexdigest(), hashlib.sha256(lines[i].encode()).hexdigest())
    return out, (len(docs), len(passed), len(first), len(out))


def test_pipeline_equals_the_serial_one(spark):
    want, sizes = serial_pipeline(spark)
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in got)


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    docs = read(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).columns == docs.columns
    for name, stage in corpus_pipeline.STAGES[1:4]:
        again = docs.filter("doc_id < 20").unionAll(docs.filter("doc_id = 3").selectExpr("doc_id", "cast(null as string) as text", "lang", "source", "n_chars"))
        sizes = defaultdict(int)
        for r in stage(spark, again, FOLDER).collect():
            sizes[r.doc_id] += 1
        assert sizes


def test_awkward_documents(spark):
    """Null, empty and very long texts, ties, repeated rows, and extra columns with names that the stages use inside."""
    from llm_helpers import CLASHING, awkward, frame, prose

    rows = awkward() + [(500 + i, prose(i, 120) + "\n" + prose(3, 90)) for i in range(12)] + [(500, prose(0, 120) + "\n" + prose(3, 90)), (None, prose(7, 200))]
    docs = frame(spark, rows).withColumnRenamed("n", "other").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars")
    kept, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, FOLDER)
        assert out.columns == docs.columns, name
        kept = spark.createDataFrame(out.collect(), docs.schema)
        assert all(r.n_chars == len(r.text) and [r[c] for c in CLASHING if c != "n"] == [i for i, c in enumerate(CLASHING) if c != "n"] for r in kept.collect() if r.text)
        sizes.append(kept.count())
    assert len(rows) > sizes[0] == sizes[1] > sizes[2] >= sizes[3] > 0
    tokens = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER).collect()
    assert len(tokens) == sizes[3] and all(r.n_tokens * 4 == len(r.ids) for r in tokens)
