"""run() of the pipeline against a plain Python version of its five stages, on planted documents."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import test_decontamination
import test_near_duplicates
import xxhash
from test_packing import VOCABULARY
from test_perplexity import plain_model
from tokenizers import Tokenizer

from gridvoice.llm import kneser_ney, packing
from gridvoice.llm.common import kept, table

LIBRARY = Tokenizer.from_str(VOCABULARY)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- the stages, one document after the other ---------------------------------------


def hash_of(text):
    """The hash that deals trusted texts into folds."""
    value = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def quality(docs, good):
    settings = kneser_ney.Settings()
    trusted = [(d, t, lang) for d, (t, lang) in docs.items() if d in good and t]
    fold = {d: hash_of(t) % settings.folds for d, t, _ in trusted}
    whole = plain_model([t for _, t, _ in trusted])
    without = {k: plain_model([t for d, t, _ in trusted if fold[d] != k]) for k in set(fold.values())}
    bins = defaultdict(list)
    for d, t, lang in trusted:
        at = math.ceil(math.log(without[fold[d]](t)) * settings.bins)
        bins[lang].append(at)
        bins["all of them"].append(at)
    limits = {}
    for lang, found in bins.items():
        found.sort()
        least = next(b for n, b in enumerate(found, 1) if n >= len(found) * settings.quantile)
        limits[lang] = math.exp(least / settings.bins) * settings.margin
    out = {}
    for d, (t, lang) in docs.items():
        if not t:
            continue
        short = max(0.0, 1 / math.sqrt(len(t)) - 1 / math.sqrt(settings.settled))
        limit = limits.get(lang, limits["all of them"]) * math.exp(settings.scatter * short)
        ratio = whole(t) / limit
        assert abs(ratio - 1) > 0.005, "a text of the fixture is too close to the threshold to compare"
        if ratio <= 1:
            out[d] = t
    return out


def tokens_of(line):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[0-9]+", "<*>", line))


def without_recurring(docs):
    places, lines_of, identical = defaultdict(set), defaultdict(set), defaultdict(set)
    for d, text in docs.items():
        for line in text.split("\n"):
            tokens = tokens_of(line)
            if tokens:
                leaf = (len(tokens), *tokens[:3])
                lines_of[leaf, tuple(tokens)].add(d)
                for at, token in enumerate(tokens):
                    places[leaf, at, token].add(d)
                if len(tokens) >= 50:
                    identical[line].add(d)
    template, holders = {}, defaultdict(set)
    for (leaf, tokens), ids in lines_of.items():
        constant = tuple((at, t) for at, t in enumerate(tokens) if len(places[leaf, at, t]) >= 5)
        if len(constant) * 100 >= len(tokens) * 80:
            template[leaf, tokens] = leaf, constant
            holders[leaf, constant] |= ids
    out = {}
    for d, text in docs.items():
        left = []
        for line in text.split("\n"):
            tokens = tuple(tokens_of(line))
            owners = holders.get(template.get(((len(tokens), *tokens[:3]), tokens)), ())
            goes = len(owners) >= 5 and d != min(owners)
            goes |= len(identical[line]) > 1 and d != min(identical[line])
            if not goes:
                left.append(line)
        text_left = "\n".join(left)
        if text_left == text or tokens_of(text_left):
            out[d] = text_left
    return out


def one_of_each(docs):
    found = test_near_duplicates.brute(list(docs.items()), 5, 80)
    return {d: t for d, t in docs.items() if found[d][2]}


def clean(docs, items):
    bad = {row[0] for row in test_decontamination.brute(list(docs.items()), items, 10) if row[4]}
    return {d: t for d, t in docs.items() if d not in bad}


def pieces(docs):
    out = set()
    for d, text in docs.items():
        ids = LIBRARY.encode(text, add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            out.add((d, n, at, len(cut), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in cut))))
    return out


# ---- planted documents ---------------------------------------------------------------


def corpus():
    rng = random.Random(11)
    syllables = ["ba", "ne", "ti", "ro", "lu", "sha", "mi", "ke", "do", "va", "en", "ar"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    vocabulary += [str(n) for n in range(10, 50)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n)) + "."

    def document():
        return "\n".join(prose(rng.randrange(12, 30)) for _ in range(rng.randrange(2, 6)))

    docs = {d: (document(), ["en", "de", None][d % 3]) for d in range(90)}
    good = set(range(0, 60))
    items = [(n, prose(30)) for n in range(3)] + [(7, "tiro lusha"), (8, None)]
    passage, planted = prose(60), {}
    for d in (90, 91, 92):
        planted[d] = "shared passage", f"{document()}\n{passage}\n{document()}"
    line, other = prose(12).split(" "), prose(12).split(" ")
    for n, d in enumerate(range(100, 107)):
        line[4:6] = vocabulary[n], str(10 + n)
        planted[d] = "template line", f"{document()}\n{' '.join(line)}"
    for n, d in enumerate(range(110, 114)):
        other[5] = str(20 + n)
        planted[d] = "too few documents", f"{document()}\n{' '.join(other)}"
    planted[120] = "exact copy", docs[70][0]
    planted[121] = "copy in capitals", docs[71][0].replace("ba", "BA")
    base = prose(100)
    planted[122] = "first of near copies", base
    words = base.split(" ")
    planted[123] = "near copy", " ".join([*words[:50], "lululu", *words[51:]])
    planted[124] = "not near enough", " ".join(w if n % 8 else "rororo" for n, w in enumerate(words))
    window = items[0][1].split(" ")
    planted[130] = "benchmark passage", f"{document()}\n{' '.join(window[4:20])}\n{document()}"
    planted[131] = "nine benchmark words", f"{document()} {' '.join(window[4:13])} {prose(20)}"
    planted[132] = "short benchmark item", f"{document()} tiro, lusha {prose(20)}"
    planted[140] = "junk", " ".join("xq#$%&"[rng.randrange(6)] * rng.randrange(1, 4) for _ in range(200))
    planted[141] = "junk", "".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(600))
    planted[142] = "long text", "\n".join(prose(25) for _ in range(200))
    planted[143], planted[144], planted[145] = ("empty", ""), ("null", None), ("blank", " \n ")
    planted[146] = "all lines recur", planted[100][1].split("\n")[-1]
    docs.update({d: (t, "en" if d % 2 else "fr") for d, (_, t) in planted.items()})
    return docs, good, items


def test_run_matches_a_plain_version(few, tmp_path):
    docs, good, items = corpus()
    rows = [(d, t, lang, f"s{d % 3}", len(t or "")) for d, (t, lang) in docs.items()]
    random.Random(2).shuffle(rows)
    few.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(d, int(d in good), 0) for d in [*good, 140, 141]]
    few.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    few.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    expected = [quality(docs, good)]
    expected.append(without_recurring(expected[-1]))
    expected.append(one_of_each(expected[-1]))
    expected.append(clean(expected[-1], items))
    # every planted case has an effect where it should
    accepted, cut, single, final = expected
    assert {140, 141, 143, 144}.isdisjoint(accepted) and good <= set(accepted)
    assert cut[90] == accepted[90] and all(len(cut[d]) < len(accepted[d]) for d in (91, 92, *range(101, 107)))
    assert all(cut[d] == accepted[d] for d in (100, *range(110, 114))) and 146 in accepted and 146 not in cut
    assert {120, 121, 123}.isdisjoint(single) and {70, 71, 122, 124} <= set(single)
    assert {130, 132} <= set(single) and {130, 132}.isdisjoint(final) and 131 in final

    directory, left = str(tmp_path), table(few, str(tmp_path), "documents")
    for (name, stage), wanted in zip(corpus_pipeline.STAGES[:-1], expected):
        left = kept(stage(few, left, directory), name)
        got = left.collect()
        assert len(got) == len(wanted), name
        assert {r["doc_id"]: r["text"] for r in got} == wanted, name
        assert all(r["n_chars"] == len(r["text"]) and r["source"] == f"s{r['doc_id'] % 3}" for r in got), name

    placed = corpus_pipeline.run(few, directory).collect()
    found = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed)
    assert set(found) == pieces(final) and set(found.values()) == {1}
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= packing.CAPACITY
    assert len(sequences) <= -(-sum(r["length"] for r in placed) // packing.CAPACITY) + 1
