import hashlib
import random
import re
import sys
import time
from pathlib import Path

import pytest
from conftest import prose
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import assert_same

from folio.llm import chat, decontaminate, line_dedup, shared

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(LOW), set()).add(doc_id)
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOW)
            if len(key) < 20 or len(holders[key]) < 3 or doc_id == max(holders[key]):
                kept.append(line)
        out[doc_id] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_line_dedup_as_brute_force(spark):
    shared = ["A line that many documents SHARE ", "  a line that many documents share", "Ünïcode läne that is shared, É", "short line", prose(9, 12)]
    rows = [(i, "\n".join([shared[i % 5], prose(i, 6), shared[(i * 3) % 5], "" if i % 4 else "\r", shared[(i + 1) % 5]])) for i in range(60)] + [(100, None), (101, ""), (102, shared[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = line_dedup.with_bitmaps(docs)
    got = {r.doc_id: (r.n, r.n - r.k, r.h) for r in cut.select("doc_id", F.size(line_dedup.LINES).alias("n"), F.size(line_dedup.KEPT).alias("k"), F.sha2(F.array_join(line_dedup.KEPT, "\n"), 256).alias("h")).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_of_keys_in_pieces(spark, monkeypatch):
    """A third of all rows hold one line; with and without its key being dealt to pieces."""
    common = "this one line is held by very many documents"
    rows = [(i, "\n".join([prose(i, 6), *([common] * (1 + i % 3)), prose(i + 1, 6)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.hot_keys(docs, 20).count() >= 1
    found = []
    for hot in (1000, 1):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        cut = line_dedup.with_bitmaps(docs)
        found.append({r.doc_id: (r.n, r.n - r.k, r.h) for r in cut.select("doc_id", F.size(line_dedup.LINES).alias("n"), F.size(line_dedup.KEPT).alias("k"), F.sha2(F.array_join(line_dedup.KEPT, "\n"), 256).alias("h")).collect()})
    assert found[0] == found[1] == brute_lines(rows)


def test_line_dedup_streams_sorted_ranges(spark):
    """The sliding pass takes the sorted ranges as they are: no exchange between them and it."""
    docs = spark.createDataFrame([(i, common_line) for i in range(9) for common_line in ["a line of many documents\nand another such line"]], "doc_id long, text string")
    kept = []
    line_dedup.shared.materialise, real = lambda df: kept.append(df) or real(df), line_dedup.shared.materialise
    try:
        line_dedup.keep_bitmaps(docs)
    finally:
        line_dedup.shared.materialise = real
    plan = kept[-1]._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("rangepartitioning")]
    assert "Window" in above and above.count("Exchange") == 1 and "hashpartitioning" not in above


def test_line_dedup_odd_rows(odd_docs, no_docs):
    done = line_dedup.dedup_lines(odd_docs)
    assert done.columns == odd_docs.columns and done.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in done.collect()}
    assert texts[1] == "" and texts[2] == "" and len(texts[5]) == 120_000
    assert line_dedup.dedup_lines(no_docs).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_hits(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(map(str, out))


@pytest.mark.parametrize("bits", [24, 1])
def test_decontaminate_as_brute_force(spark, monkeypatch, bits):
    """Also with filters that let nearly everything through."""
    monkeypatch.setattr(decontaminate, "BITS_PER_WINDOW", bits)
    items = [(1, prose(50, 40)), (2, prose(51, 10)), (3, "three Small words"), (4, "one"), (5, None), (6, "--"), (7, prose(50, 40)), (8, "la " * 30), (9, prose(52, 9))]
    a, b = prose(50, 40).split(), prose(52, 9)
    docs = [
        (0, " ".join(["x y z", *a[5:15], "end"])),
        (1, " ".join(["x", *a[5:14], "end"])),
        (2, prose(51, 10).upper() + "! " + prose(50, 40)),
        (3, "they said three, SMALL words. one more"),
        (4, "la " * 200),
        (5, None),
        (6, ""),
        (7, b),
        (8, prose(70, 3000)),
        (9, "three small"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.report(d, i).collect()]
    assert sorted(map(str, got)) == brute_hits(docs, items)
    assert sorted(r.doc_id for r in decontaminate.remove_contaminated(d, i).collect()) == [1, 5, 6, 8, 9]


def test_decontaminate_by_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(decontaminate.shared, "checked_broadcast", lambda df, bound=0, size=None: df)
    d = spark.createDataFrame([(1, prose(50, 60)), (2, prose(53, 60))], "doc_id long, text string")
    i = spark.createDataFrame([(1, prose(50, 40))], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.report(d, i).collect()} == {1: 40, 2: 0}


def test_filter_holds_what_it_was_made_of_and_little_else(spark):
    made = spark.range(5000).select(F.xxhash64("id").alias("f"))
    bits = decontaminate.bloom(made).scalar()
    tried = spark.range(10_000).select("id", F.xxhash64("id").alias("f")).select("id", decontaminate.passes(bits, F.col("f")).alias("there"))
    assert tried.filter("there AND id < 5000").count() == 5000 and tried.filter("there AND id >= 5000").count() < 250
    assert tried.limit(0).count() == 0 and decontaminate.bloom(made.limit(0)).count() == 1


def test_decontaminate_odd_rows(odd_docs, no_docs, spark):
    items = spark.createDataFrame([(1, prose(2, 30)), (1, prose(2, 30))], "item_id long, text string")
    got = decontaminate.report(odd_docs, items).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r.doc_id for r in got if r.contaminated) == [7, 7, 8]
    left = decontaminate.remove_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 3
    assert decontaminate.report(no_docs, items).count() == 0
    assert decontaminate.report(odd_docs, items.limit(0)).filter("contaminated").count() == 0


def test_chat_links_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there my friend\nhow is the weather today"),
        (1, 1, "assistant", "> Hello there my friend\n> how is the weather today\nFine and sunny outside"),
        (1, 2, "user", "totally unrelated thing"),
        (1, 3, "user", ">> Hello there  MY friend\n>> how is the weather today\n> Fine and sunny outside\n\nThanks a lot for it"),
        (1, 5, None, None),
        (2, 0, "user", ""),
        (2, 1, "user", "> quoting nothing known here\n  > Fine and sunny outside\nok"),
        (2, 1, "user", "> quoting nothing known here\n  > Fine and sunny outside\nok"),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("version", F.lit(1))
    places = {(r.conv_id, r.turn, r.position) for r in chat.link(df).collect()}
    assert places == {(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 4), (1, 5, 5), (2, 0, 1), (2, 1, 2), (None, None, None)}
    got = sorted(((r.conv_id or 0, r.turn or 0, r.reply_to, r.n_quotes, r.n_linked, r.text) for r in chat.link(df).collect()), key=str)
    assert got == sorted(
        [
            (1, 0, None, 0, 0, "Hello there my friend\nhow is the weather today"),
            (1, 1, 0, 3, 3, "Fine and sunny outside"),
            (1, 2, 1, 0, 0, "totally unrelated thing"),
            (1, 3, 1, 4, 4, "Thanks a lot for it"),
            (1, 5, None, 0, 0, ""),
            (2, 0, None, 0, 0, ""),
            (2, 1, 0, 3, 0, "ok"),
            (2, 1, 0, 3, 0, "ok"),
            (0, 0, None, 0, 0, ""),
        ],
        key=str,
    )
    assert chat.format_messages(chat.link(df.limit(0))).count() == 0


def quoting(n_convs, n_turns, seed):
    """Conversations whose messages quote earlier ones on up to three levels, short ones too."""
    rng, rows = random.Random(seed), []
    for conv in range(n_convs):
        said = []
        for turn in range(n_turns):
            lines = []
            if said and rng.random() < 0.8:
                depth, at = rng.randint(1, 3), rng.randrange(len(said))
                for line in said[at].split("\n"):
                    lines.append(rng.choice([">", "> ", " > "]) + rng.choice(["", "> ", ">"]) * (depth - 1) + (line.upper() if rng.random() < 0.3 else line))
                if rng.random() < 0.3:
                    lines.append("> nobody ever said this " + str(rng.randrange(99)))
            own = "\n".join(rng.choice(["Why?", "ok", prose(rng.randrange(30), 5), "", prose(rng.randrange(10**6), 7)]) for _ in range(rng.randint(1, 4)))
            said.append(own)
            rows.append((conv, turn * 2 if conv % 3 == 0 else turn, rng.choice(["user", "assistant", None]), "\n".join([*lines, own])))
    return rows


def brute_chat(rows):
    parse = lambda text: [(len(re.sub("[^>]", "", (m := re.match(r"(?:[ \t]*(?:>[ \t]?)+)?", line))[0])), line[m.end() :]) for line in (text or "").split("\n")]
    normal = lambda body: re.sub(r"[\x00-\x20]+", " ", body.lower()).strip(" ")

    def units(marked):
        found, run = set(), []
        for level, body in [*marked, (None, "")]:
            norm = normal(body)
            if run and (norm == "" or level != run[0][0]):
                found.add((run[0][0], " ".join(n for _, n in run)))
                run = []
            if norm and level is not None:
                run.append((level, norm))
                found.add((level, norm))
        return found

    marked = {(c, t): parse(text) for c, t, _, text in rows}
    origin = {}
    for (c, t), m in marked.items():
        for level, norm in units(m):
            if level == 0:
                origin[c, norm] = min(t, origin.get((c, norm), t))
    out = []
    for c, t, role, _ in rows:
        quotes = [(level, norm) for level, norm in units(marked[c, t]) if level]
        votes = {}
        linked = 0
        for level, norm in quotes:
            o = origin.get((c, norm))
            if o is not None and o < t:
                linked += 1
                if level == 1:
                    votes[o] = votes.get(o, 0) + len(norm)
        best = max(((size, o) for o, size in votes.items()), default=None)
        reply = best[1] if best else t - 1 if (c, t - 1) in marked else None
        own = "\n".join(body for level, body in marked[c, t] if level == 0).strip("\n")
        place = sorted(x for k, x in marked if k == c).index(t) + 1
        out.append((c, t, place, role, reply, len(quotes), linked, f"<|{(role or 'user').lower()}|>\n{own}\n<|end|>"))
    return sorted(out, key=str)


def test_chat_as_brute_force_and_sql(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(chat, "PIECE", 4)
    rows = quoting(12, 11, 3)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = chat.query(spark, str(tmp_path)).select("conv_id", "turn", "position", "role", "reply_to", "n_quotes", "n_linked", "message").collect()
    want = brute_chat(rows)
    assert sum(r[5] > 0 for r in want) > 60 and sum(r[6] > 1 for r in want) > 40
    assert sorted(map(tuple, got), key=str) == want
    assert_same(spark, str(tmp_path), chat.query, chat.SQL)


def test_chat_odd_rows(odd_docs, no_docs):
    messages = lambda d: d.withColumns({"conv_id": F.lit(1), "turn": F.col("doc_id"), "role": F.lit("user"), **{c: F.lit(0) for c in ("level", "norm", "origin", "position", "follows", "_conv")}})
    got = chat.link(messages(odd_docs)).collect()
    assert len(got) == odd_docs.count() and max(len(r.text) for r in got) > 120_000
    assert chat.link(messages(no_docs)).count() == 0


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    nowhere = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_folder(nowhere)
    nowhere.sparkContext.master = "local[2]"
    assert shared.shared_folder(nowhere) == shared.shared_folder(nowhere)


def test_samples_hold_their_bounds(spark):
    rows = [(i, "a" if i % 3 else None, "x" * (100 if i % 50 else 5000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string")
    some = shared.sample_texts(df, {None: 300}, 1 << 20, "label")
    counts = {v: some["label"].to_pylist().count(v) for v in ("a", None)}
    assert 220 < counts["a"] < 380 and 220 < counts[None] < 380
    tight = shared.sample_texts(df, {None: 300}, 20_000, "label")
    assert 0 < sum(map(len, tight["text"].to_pylist())) <= 20_000
    assert shared.sample_texts(df.repartition(7), {None: 300}, 20_000, "label").equals(tight)
    assert shared.sample_texts(df.limit(0), {None: 300}, 20_000).num_rows == 0


def test_broadcasts_are_checked_by_rows_and_bytes(spark):
    hinted = lambda df, **k: "ResolvedHint" in shared.checked_broadcast(df, **k)._jdf.queryExecution().analyzed().toString()
    df = spark.range(50).withColumn("items", F.array(F.lit("x")))
    assert hinted(df) and not hinted(df, bound=10) and not hinted(df, size=F.lit(1 << 20))


def test_a_large_benchmark_is_joined_by_what_passes(spark):
    """Only rows that the filter lets through leave the pass over documents; the rest is not shuffled."""
    kept = []
    real = decontaminate.shared.materialise
    decontaminate.shared.materialise = lambda df: kept.append(df) or real(df)
    try:
        docs = spark.createDataFrame([(i, prose(3000 + i, 60)) for i in range(80)] + [(100, prose(50, 60))], "doc_id long, text string")
        items = spark.createDataFrame([(i, prose(5000 + i, 80)) for i in range(400)] + [(999, prose(50, 40))], "item_id long, text string")
        assert {r.doc_id for r in decontaminate.report(docs, items).filter("contaminated").collect()} == {100}
    finally:
        decontaminate.shared.materialise = real
    measured = next(df for df in kept if "near" in df.columns)
    plan = measured._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan and "Subquery" in plan
    # 80 documents of 50 windows and more in runs, of which the filter stops nearly all
    assert measured.select(F.sum(F.size("near"))).first()[0] < 200


def test_chat_of_a_line_with_a_million_marks(spark):
    rows = [(1, 1, "user", "first words"), (1, 2, "user", ">" * 1_000_000 + " first words\n> first words"), (1, 3, "user", "> " * 500_000 + "x"), (1, 4, "user", " \t" * 500_000 + ">y")]
    got = {r.turn: r for r in chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[2].reply_to == 1 and got[2].n_quotes == 2 and got[2].n_linked == 2 and got[2].text == ""
    assert got[3].n_quotes == 1 and got[4].n_quotes == 1


def test_chat_of_a_message_with_many_lines(spark):
    lines = [f"line number {i % 150_000}" for i in range(200_000)]
    rows = [(1, 1, "user", "\n".join(lines)), (1, 2, "user", "\n".join("> " + x for x in lines) + "\nand so?")]
    began = time.perf_counter()
    got = {r.turn: r for r in chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    # the lines and the whole
    assert got[2].reply_to == 1 and got[2].n_quotes == got[2].n_linked == 150_001 and got[2].text == "and so?"
    assert time.perf_counter() - began < 60


def test_marks_as_greedy_ones(spark):
    draw = random.Random(3)
    lines = ["".join(draw.choices(["> ", ">", " ", "\t", "a", ">>", "> > "], k=draw.randint(0, 9))) for _ in range(400)]
    got = spark.createDataFrame([("\n".join(lines),)], "text string").select(chat.quote_levels(F.col("text")).alias("m")).first()[0]
    for line, mark in zip(lines, got, strict=True):
        found = re.match(r"[ \t]*(?:>[ \t]?)+", line)
        assert (mark.level, mark.body) == ((found.group().count(">"), line[found.end() :]) if found else (0, line))


def test_chat_over_written_quotes_as_sql(spark, smallest):
    found = chat.quoted_query(spark, smallest)
    assert found.filter("n_linked > 0").count() > 50
    assert_same(spark, smallest, chat.quoted_query, chat.QUOTED_SQL)


def test_long_contaminated_text_in_one_pass(spark):
    text, took = prose(60, 40_000), []
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    for n in (20_000, 40_000):
        d = spark.createDataFrame([(1, " ".join(text.split()[:n]))], "doc_id long, text string")
        decontaminate.report(d.limit(0), items).collect()
        began = time.perf_counter()
        got = decontaminate.report(d, items).collect()
        took.append(time.perf_counter() - began)
        assert [(r.n_words, r.n_hit, r.item_ids) for r in got] == [(n, n, ["1"])]
    assert took[1] < 3 * took[0]


def test_filters_in_parts_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(50 + i, 60)) for i in range(8)] + [(20, "four small words here")], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join([prose(200 + i, 30), prose(50 + i % 9, 60)[10 : 60 + 20 * (i % 9)], "four small words here" if i % 2 else "", prose(300 + i, 30)])) for i in range(40)] + [(99, None)], "doc_id long, text string")
    row = lambda r: (r.doc_id or -1, r.n_words, r.n_hit, r.item_ids, [tuple(s) for s in r.spans])
    whole = sorted(map(row, decontaminate.report(docs, items).collect()))
    made = []
    monkeypatch.setattr(decontaminate, "MOST_BITS", 512)
    monkeypatch.setattr(decontaminate, "bloom", lambda h, real=decontaminate.bloom: made.append(h) or real(h))
    assert sorted(map(row, decontaminate.report(docs, items).collect())) == whole
    assert len(made) > 4 and sum(r[2] > 0 for r in whole) > 20


def test_a_text_above_the_bound_costs_no_other_its_place(spark):
    """The first drawn, the last drawn and all but one too large; copies count once."""
    small = [(i, f"text number {i} of some length") for i in range(100)]
    draws = spark.createDataFrame(small, "doc_id long, text string").select("doc_id", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)).alias("d")).orderBy("d").collect()
    for large in ([draws[0].doc_id], [draws[-1].doc_id], [r.doc_id for r in draws[1:]]):
        rows = [(i, "x" * 50_000 if i in large else t) for i, t in small]
        got = shared.sample_texts(spark.createDataFrame(rows, "doc_id long, text string"), {None: 1000}, 40_000)
        assert got["key"].to_pylist() == [i for i, _ in small if i not in large]
    alike = spark.createDataFrame(small[:3] * 500, "doc_id long, text string")
    assert shared.sample_texts(alike, {None: 5000}, 40_000).num_rows == 3
    # the bytes are filled up by the texts drawn next that fit
    mixed = spark.createDataFrame([(i, "y" * (900 if i % 2 else 40)) for i in range(200)], "doc_id long, text string")
    total = sum(len(t) for t in shared.sample_texts(mixed, {None: 1000}, 9000)["text"].to_pylist())
    assert 8900 < total <= 9000


def test_conversations_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 3)
    rows = [(1, t, "user" if t % 2 else None, f"> m{t - 1}\nm{t}") for t in range(1, 9)] + [(1, 4, None, "> m3\nm4"), (1, None, "user", "lost"), (None, 5, "user", "alone")]
    done = chat.format_messages(chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {(r.conv_id, r.part): (r.n_messages, r.conversation) for r in chat.transcripts(done).collect()}
    say = lambda t: f"<|user|>\nm{t}\n<|end|>"
    assert got == {(1, p): (len(ts), "\n".join(map(say, ts))) for p, ts in enumerate(([1, 2, 3], [4, 5, 6], [7, 8]))} | {(None, 0): (1, "<|user|>\nalone\n<|end|>")}
    assert chat.transcripts(done.limit(0)).count() == 0
