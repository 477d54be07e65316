import random

import numpy as np

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import substrings
from ledgerlight.llm.substrings import substring_dedup

SF = "/root/testdata/sf0.001"
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "tre", "sun", "vor") for b in ("n", "dt", "ska", "rim", "o", "est", "ing")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n))


def chunks(text):
    raw = text.encode()
    data, _, starts, ends, _ = substrings._buffer([raw])
    digests = substrings._digests(data, starts, ends)
    return [(int(s), min(int(e), len(raw)), int(h)) for s, e, h in zip(starts, ends, digests)]


def brute(docs, least):
    """Chunk digests seen before, joined to runs, one document after the other."""
    seen, out = set(), {}
    for k, text in sorted(docs.items()):
        raw, runs, last = text.encode(), [], False
        for s, e, h in chunks(text):
            if h in seen:
                if last:
                    runs[-1][1] = e
                else:
                    runs.append([s, e])
            last = h in seen
            seen.add(h)
        for s, e in reversed([r for r in runs if len(raw[r[0]:r[1]].split()) >= least]):
            raw = raw[:s] + raw[e:]
        out[k] = raw.decode()
    return out


def test_gear_is_the_rolling_hash():
    data = np.frombuffer(bytes(range(1, 200)), dtype=np.uint8)
    h, want = 0, []
    for b in data:
        h = (h * 2 + int(substrings._GEAR[b])) % (1 << 16)
        want.append(h)
    assert substrings.gear(data).tolist() == want


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(4)
    passage = prose(rng, 120)
    for before in ("", "x ", prose(rng, 37) + " "):
        text = before + passage + " " + prose(rng, 30)
        own = chunks(text)
        assert own[0][0] == 0 and own[-1][1] == len(text.encode()) and all(a[1] == b[0] for a, b in zip(own, own[1:]))
        inside = {h for s, e, h in own if s >= len(before) + 60 and e <= len(before) + len(passage) - 60}
        assert len(inside) > 5 and inside <= {h for *_, h in chunks(passage)}


def test_documents_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    rows = substring_dedup(df).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == brute(docs, substrings.MIN_WORDS)
    for r in rows:
        text = docs[r["doc_id"]]
        for s in reversed(r["removed"]):
            assert len(text[s["start"]:s["end"]].split()) == s["words"] >= substrings.MIN_WORDS
            text = text[:s["start"]] + text[s["end"]:]
        assert text == r["text"]


def test_planted_passages_go_and_clean_documents_stay(spark):
    rng = random.Random(9)
    passages = [prose(rng, 60) for _ in range(8)]
    docs = {}
    for i in range(160):
        own = prose(rng, rng.randrange(40, 200))
        at = own.find(" ", rng.randrange(len(own) - 40))
        docs[i] = own[:at] + " " + passages[i % 8] + own[at:] if i < 80 else own
    got = {r["doc_id"]: r["text"] for r in substring_dedup(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert all(got[i] == docs[i] for i in [*range(8), *range(80, 160)])
    shorter = [i for i in range(8, 80) if len(docs[i].split()) - len(got[i].split()) >= 25]
    assert len(shorter) >= 70


def test_edge_rows(spark):
    df = edge_docs(spark)
    out = substring_dedup(df)
    assert out.columns == [*df.columns, "n_chunks_", "n_repeated_", "removed_"]
    got = rows_by_key(out, "doc_id")
    assert got[2][0]["text"] is None and got[2][0]["n_chunks_"] == 0 and got[3][0]["text"] == ""
    assert got[9][0]["text"] == df.where("doc_id = 9").first()["text"]
    assert len(got[7]) == 2 and got[7][0] == got[7][1]
    assert len(got[6][0]["text"]) < 5000            # one phrase over and over
    assert substring_dedup(empty_docs(spark)).count() == 0


def test_text_without_blanks(spark):
    rng = random.Random(3)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    thai = lambda n: "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(n))
    data = lambda n: "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(n))
    docs, planted = {}, {}
    for i, text in enumerate((han, thai, data)):
        copied, passage = text(400), text(600)
        docs |= {10 * i: copied, 10 * i + 1: copied, 10 * i + 2: text(300) + passage + text(300), 10 * i + 3: text(250) + passage + text(350), 10 * i + 4: text(900)}
        planted[10 * i + 3] = passage
    clauses = " ".join(han(9) for _ in range(18))       # fewer than 20 words, none of them long
    docs |= {40: clauses, 41: clauses}
    got = {r["doc_id"]: r["text"] for r in substring_dedup(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert all(got[k] == docs[k] for k in docs if k % 10 in (0, 2, 4)) and not any(got[k] for k in (1, 11, 21, 41))
    for k, passage in planted.items():
        before, after = docs[k].split(passage)
        assert got[k].startswith(before) and got[k].endswith(after) and len(docs[k]) - len(got[k]) >= 300
