"""Roles, profiles, synthesis, tokens, plans, logs and the ledger on small tables."""

import gzip
import itertools
import re

import pytest
from pyspark.sql import functions as F

from textloom.operators import prepare, profiles, roles, tokens
from textloom.plans import runplan
from textloom.sources import logfiles, logs, tables

CATALOG = {
    "sft": ["ID", "Prompt", "RESPONSE", "output"],
    "messages": ["messages"],
    "causal": ["text", "url"],
    "prompt": ["prompt"],
    "image": ["Picture", "img", "label", "text"],
    "image_only": ["image", "id"],
    "image_prompt": ["photo", "prompt"],
    "none": ["a", "b"],
    "twice": ["Answer", "ANSWER", "question"],
}


def test_roles(spark):
    rows = [(t, i, c) for t, cs in CATALOG.items() for i, c in enumerate(cs)]
    catalog = spark.createDataFrame(rows, "table_name string, position int, column_name string")
    got = {r.table_name: (r.mode, r.image, r.question, r.chosen, r.rejected) for r in roles.map_roles(catalog).collect()}
    assert got == {
        "sft": ("sft", None, "Prompt", "RESPONSE", None),
        "messages": ("sft", None, None, "messages", None),
        "causal": ("causal", None, None, "text", None),
        "prompt": ("causal", None, None, "prompt", None),
        "image": ("multimodal", "img", "text", "label", None),
        "image_only": (None, None, None, None, None),
        "image_prompt": ("causal", None, None, "prompt", None),
        "none": (None, None, None, None, None),
        "twice": ("sft", None, "question", "ANSWER", None),
    }
    for t, cs in CATALOG.items():  # the driver's answer for one table is the same
        if got[t][0] is None:
            with pytest.raises(ValueError):
                roles.table_roles(cs)
        else:
            one = roles.table_roles(cs)
            assert (one["mode"], one["image"], one["question"], one["chosen"], one["rejected"]) == got[t]
    forced = {r.table_name: r.question for r in roles.map_roles(catalog, "chat").collect()}
    assert forced["messages"] == "messages" and forced["sft"] is None
    assert {r.table_name: r.column_name for r in roles.resolve_role(catalog, "chosen", "multimodal").collect()}["image"] == "label"


def test_preflight(spark, tmp_path):
    spark.range(1).withColumn("Text", F.lit("x")).write.parquet(str(tmp_path / "a"))
    assert roles.check_schema(spark, str(tmp_path / "a")) == "causal"
    spark.range(1).write.parquet(str(tmp_path / "b"))
    with pytest.raises(ValueError):
        roles.check_schema(spark, str(tmp_path / "b"))


def test_profiles(spark):
    names = ["/x/Phi-2", "/phi-2/llama", "microsoft/Phi-3-Vision-128k", "phi-3-mini", "phi-2-phi-3", ""]
    df = spark.createDataFrame([(n,) for n in names], "model string")
    got = {r.model: (r.profile, r.grad_accum, r.modules_to_save) for r in profiles.profile_lookup(df, "model").collect()}
    assert [got[n][0] for n in names] == ["phi-2", "default", "phi-3-vision", "phi-3", "phi-2", "default"]
    assert got["/x/Phi-2"] == ("phi-2", 16, None) and got["phi-3-mini"][2] == ["lm_head"]


def test_synthesis(spark):
    rows = [(1, "q", "a"), (2, None, "a"), (3, "persistent", "a"), (4, " ", None), (5, "persistent", "persistent"), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, Instruction string, Output string")
    got = {r.id: r.text for r in prepare.prepare(df, "id").collect()}
    assert got == {1: "q\n\na", 2: "a", 3: "\n\na"}  # a part cleaned to nothing still counts
    multi = df.select("id", prepare.multimodal_text(F.col("Instruction"), F.col("Output")).alias("t"))
    assert {r.id: r.t for r in multi.collect()} == {1: "q\n\na", 2: "a", 3: "\n\na", 4: "", 5: "\n\n", 6: ""}
    images = df.withColumn("Photo", F.lit(b"\xff\xd8\xff\x00")).withColumnRenamed("Output", "caption")
    out = prepare.prepare(images, "id", forced_mode="multimodal", clean_mode="latex")
    assert set(out.columns) == {"id", "image", "text"} and out.count() == 3
    chat = spark.createDataFrame([(1, [("user", "a <b> c"), ("assistant", "**d**")])], "id int, m array<struct<role:string,content:string>>")
    assert chat.select(prepare.chat_text(F.col("m"), "code")).first()[0] == "a  c\n\n"


def test_preview_and_images(spark):
    df = spark.createDataFrame([("x" * 130, None)], "q string, a string")
    assert tuple(prepare.preview(df, "q", "a").first()) == ("x" * 120 + "…", "")
    assert prepare.preview(df.where("false"), "q", None).count() == 0
    heads = [b"\x89PNG\r\n\x1a\n..", b"\xff\xd8\xffx", b"GIF89a", b"GIF88a", b"", None, b"RIFFxxxx"]
    df = spark.createDataFrame([(h,) for h in heads], "b binary")
    assert tuple(prepare.image_drop_counts(df, "b").first()) == (7, 4, 3)


def test_shuffle_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("x", F.col("id") * 2)
    orders = [[r.id for r in prepare.seeded_shuffle(df.repartition(n), "id", 9, parts).collect()] for n, parts in ((3, 4), (8, 1), (5, 13))]
    assert orders[0] == orders[1] == orders[2] != list(range(500))
    assert sorted(orders[0]) == list(range(500))
    assert [r.id for r in prepare.seeded_shuffle(df, "id", 10).collect()] != orders[0]
    assert prepare.table_bytes(df) == 500 * 16
    for size, n in ((1000, 8), (4000, 2), (1 << 20, 1)):  # ranges from the bytes of the table
        out = prepare.seeded_shuffle(df, "id", 9, range_bytes=size)
        assert out.rdd.getNumPartitions() == n and [r.id for r in out.collect()] == orders[0]


def test_tokens(spark):
    df = spark.createDataFrame([(1, "the cat, the dog 42"), (2, ""), (3, "the é!")], "id int, text string")
    vocab = tokens.vocabulary(df, "text", 3)
    got = {r.token: r.id for r in vocab.collect()}
    assert got["the"] == 4 and len(got) == 7 and set(got) == {"<|pad|>", "<|startoftext|>", "<|endoftext|>", "<|unk|>", "the", "!", ","}
    rows = {r.id: r for r in tokens.tokenize(df, "text", vocab, 4).collect()}
    assert rows[1].input_ids == [1, 4, 3, got[","]] and rows[1].length == 7 and rows[1].attention_mask == [1, 1, 1, 1]
    assert rows[2].input_ids == [1] and rows[3].labels == [1, 4, 3, got["!"]]
    bare = tokens.tokenize(df, "text", vocab, 4, bos=False)
    assert {r.id: r.input_ids for r in bare.collect()}[2] == []
    plain = tokens.vocabulary(df, "text", 3, specials=[("eos", "<|endoftext|>")])
    assert tokens.special_ids(plain).first().pad_id == 0


def test_length_profile(spark):
    df = spark.createDataFrame([(i,) for i in [10, 20, 30, 40]], "length int")
    assert tuple(tokens.length_profile(df, "length").first()) == (4, 25, 38, 39, 128)
    assert tokens.length_profile(df.select((F.col("length") * 100).alias("length")), "length").first().max_length == 1024
    with pytest.raises(Exception, match="no rows"):
        tokens.length_profile(df.where("false"), "length").collect()


def test_masks_and_batches(spark):
    rows = [(0, [5, 7, 3, 7, 2]), (0, [1, 2]), (1, [7]), (1, []), (2, [4] * 9)]
    df = spark.createDataFrame(rows, "batch int, input_ids array<bigint>").withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1).cast("bigint")))
    labels = [r[0] for r in df.select(tokens.assistant_labels(F.col("input_ids"), 7)).collect()]
    assert labels == [[-100] * 4 + [2], [1, 2], [-100], [], [4] * 9]
    for r in tokens.pad_batches(df, ["batch"], 99).collect():
        assert len(r.input_ids) == len(r.attention_mask) == len(r.labels) == r.pad_len and r.pad_len % 8 == 0
        assert r.labels == [x if k else -100 for x, k in zip(r.input_ids, r.attention_mask)]
        assert all(x == 99 for x, k in zip(r.input_ids, r.attention_mask) if not k)
    long = spark.range(1000).withColumn("length", (F.col("id") * 37 % 211).cast("int"))
    out = tokens.length_batches(long, "id", "length", 8, 3, rows_per_shard=250)
    assert out.count() == 1000 and out.select("shard").distinct().count() == 4
    assert tokens.padding_waste(out, "length", ["shard", "batch"]).agg(F.avg("waste")).first()[0] < 0.25


def test_cross_entropy(spark):
    import math

    rows = [(1, 0, [0.0, 0.0], 1), (1, 1, [1000.0, 0.0], 0), (1, 2, [0.0, 1.0], 1), (1, 3, [0.0, 0.0], -100)]
    df = spark.createDataFrame(rows, "seq int, pos int, logits array<double>, label int")
    r = tokens.cross_entropy(df, "seq").first()
    assert r.positions == 2 and r.eval_loss == pytest.approx((math.log(2) + 1000) / 2) and r.perplexity == pytest.approx(math.exp(r.eval_loss))
    far = spark.createDataFrame([(1, 0, [2000.0, 0.0], 0), (1, 1, [0.0, 0.0], 1)], df.schema)
    assert tokens.cross_entropy(far).first().perplexity == math.inf


def test_plans(spark):
    rows = [("a", 0, 1, None), ("b", 31_999, 2, None), ("c", 32_000, 2, None), ("d", 100, 1, 500), ("e", 8 * 1000, 1, None)]
    df = spark.createDataFrame(rows, "dataset string, rows bigint, epochs int, fixed_steps bigint").withColumn("grad_accum", F.lit(8)).withColumn("learning_rate", F.lit(1e-5))
    got = {r.dataset: r for r in runplan.plan_runs(df).collect()}
    assert not got["a"].valid and got["b"].min_stop_steps == 879 and got["c"].min_stop_steps == 720
    assert got["d"].total_steps == 500 and got["d"].epochs == 41 and not got["d"].early_stop and got["d"].hard_cap_steps is None
    assert (got["e"].total_steps, got["e"].warmup_steps, got["e"].hard_cap_steps) == (1000, 75, 800)
    grid = spark.range(1, 4000).select((F.col("id") * 23).alias("r"), (F.col("id") % 7).cast("int").alias("e")).withColumn("m", runplan.min_steps(F.col("r"), 1, 8))
    kinds = {r[0] for r in grid.select(runplan.scheduler(F.col("r"), F.col("e"), F.col("m"))).distinct().collect()}
    assert kinds == {"linear", "cosine"}  # restarts would need contradicting conditions
    with pytest.raises(Exception, match="not enough data"):
        runplan.plan_runs(df, strict=True).collect()


def test_log_lines_from_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("start\n{'loss': 1.5, 'step': 1}\nx {'loss': 2.5, 'step': 2} y\n{'eval_loss': 1}\n{'loss': nope}\n")
    (tmp_path / "b.log").write_text("{'loss':\n3.5}\n{'loss': 4.5\n}\n{oops}\n{'loss':\n5.5}")
    lines = logs.read_lines(spark, str(tmp_path))
    got = [(r.entry["loss"], r.entry.get("step")) for r in logs.parse_lines(lines).orderBy("seq").collect()]
    assert got == [("1.5", "1"), ("2.5", "2")]
    files = spark.read.text(str(tmp_path), wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    rows = logs.entry_fields(logs.parse_files(files)).select("file", "loss").collect()
    assert sorted((r.file, r.loss) for r in rows) == [("a.log", 1.5), ("a.log", 2.5), ("b.log", 3.5), ("b.log", 4.5)]
    for split in (20, 1 << 20):
        found = logs.entry_fields(logs.read_entries(spark, str(tmp_path), split)).collect()
        assert sorted((r.file[-5:], r.loss) for r in found) == [("a.log", 1.5), ("a.log", 2.5), ("b.log", 3.5), ("b.log", 4.5)]
    assert "Exchange" not in logs.parse_lines(lines)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 5, 1 << 20])
def test_log_ranges(tmp_path, monkeypatch, block):
    """Ranges of any size give the lines and objects of the whole file, each once, with their place."""
    monkeypatch.setattr(logfiles, "BLOCK", block)
    text = "a\nbb\r\n\rc é\r\r\n{'loss':\n1} {x{y: 2}z} {} {open\n{\n'k': 3\n\n} }} last {never closed\nend"
    for name, body in (("x.log", text), ("y.log", "\n" + text + "\n"), ("z.log", "{" * 3), ("w.log", "}{\r"), ("v.log", "")):
        raw = body.encode()
        (tmp_path / name).write_bytes(raw)
        ends = [(m.start(), m.end()) for m in re.finditer(rb"\r\n|\n|\r", raw)]
        begins = [0, *(e for _, e in ends)]
        want = {"line": [(b, raw[b:e]) for b, e in zip(begins, [*(s for s, _ in ends), len(raw)]) if b < len(raw)],
                "object": [(m.start(), m.group()) for m in re.finditer(rb"\{[^{}]+\}", raw)]}
        for unit, split in itertools.product(want, (1, 2, 3, 7, 1000)):
            reader = logfiles.LogReader(str(tmp_path / name), unit, split)
            parts = reader.partitions()
            assert block > 1 or len(parts) == max(1, -(-len(raw) // split))
            rows = [(r["seq"], r["value"].encode()) for p in parts for b in reader.read(p) for r in b.to_pylist()]
            assert rows == want[unit], (name, unit, split)


def test_trainer_states(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"epoch": 1.0,\n "log_history": [{"loss": 2.0, "step": 1}, {"eval_loss": 1.0}, {"loss": 1.0, "step": 2}]}')
    (tmp_path / "t.json").write_text("{broken")
    rows = logs.entry_fields(logs.read_trainer_states(spark, str(tmp_path))).orderBy("seq").collect()
    assert [(r.seq, r.step, r.loss) for r in rows] == [(1, 1, 2.0), (3, 2, 1.0)]


def test_small_files(spark, tmp_path):
    """A file for each key, written and read many at a time: a batch holds the rows of several, and a task reads them all."""
    rows = [(k, f"{{'loss': {k}.5}}\n {{'step': 1}} \x85\r") for k in range(300)] + [(7, "{'loss': 8}"), (7, None), (None, "é")]
    df = spark.createDataFrame(rows, "k bigint, value string").coalesce(1)
    logfiles.write_files(df, "k", str(tmp_path / "logs"))
    files = {f.name: f.read_bytes().decode() for f in tmp_path.glob("logs/*/*")}
    assert len(files) == 301 and files["k=7-000000.txt"] == rows[7][1] + "\n{'loss': 8}\n\n" and files["k=__HIVE_DEFAULT_PARTITION__-000000.txt"] == "é\n"
    assert not [f for f in tmp_path.glob("logs/*") if f.name != "part=000000"]
    for unit in ("line", "object"):
        reader = logfiles.LogReader(str(tmp_path / "logs"), unit, 1 << 20)
        parts = reader.partitions()
        batches = [b for p in parts for b in reader.read(p)]
        assert len(parts) == len(batches) == 1 and len(set(batches[0].column(0).to_pylist())) == (301 if unit == "line" else 300)
        found = logfiles.read_units(spark, str(tmp_path / "logs"), unit)
        assert found.count() == batches[0].num_rows


def test_trainer_states_as_spark_reads_them(spark, tmp_path):
    """The files that Spark's reader finds, with the same names, but not in a task for each 32 of them."""
    state = '{"log_history": [{"loss": %d, "step": 1}, {"eval_loss": 2}, {"loss": "NaN"}]}'
    for k, name in enumerate(["a b#%é.json", "_hidden", ".hidden", "_k=1.txt", "below/x.json"]):
        (tmp_path / "flat" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "flat" / name).write_text(state % k)
    with gzip.open(tmp_path / "flat" / "c.json.gz", "wt") as f:
        f.write(state % 9 + "\n" + state % 10)
    for k in range(200):
        (tmp_path / "parts" / f"k={k % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "parts" / f"k={k % 3}" / f"{k}.json").write_text(state % k)
    for name in ("flat", "parts", "parts/k=1/1.json"):
        path = str(tmp_path / name)
        files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
        want = sorted(map(str, logs.entry_fields(logs.parse_trainer_states(files)).collect()))
        for own in (path, "file:" + path, "file://" + path, path + "*"):
            assert sorted(map(str, logs.entry_fields(logs.read_trainer_states(spark, own)).collect())) == want, own
    assert logs.read_trainer_states(spark, str(tmp_path / "parts")).rdd.getNumPartitions() == 1


def test_dataset_names_and_ledger(spark, tmp_path):
    paths = ["/d/a.b.parquet", "c.parquet", "/x/.hidden", "/x/..", "plain", "/y/c.csv", "e."]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in df.select(tables.dataset_name(F.col("path"))).collect()] == ["a.b", "c", ".hidden", "..", "plain", "c", "e"]
    ledger = str(tmp_path / "ledger")
    tables.empty_ledger(spark, ledger)
    for _ in range(2):
        tables.append_ledger(df, "path", ledger)
    names = sorted(["a.b", "c", ".hidden", "..", "plain", "e"])
    assert sorted(r.dataset_name for r in spark.read.parquet(ledger).collect()) == names
    # Two writers that both saw an empty ledger: each name is one writer's.
    both = str(tmp_path / "both")
    tables.empty_ledger(spark, both)
    new = tables.ledger_check(df, "path", tables.read_ledger(spark, both)).where("is_new").select("dataset_name").collect()
    claims = {tables.claim(spark.createDataFrame(new), both) for _ in range(2)}
    rows = tables.read_ledger(spark, both).collect()
    assert sorted(r.dataset_name for r in rows) == names and len({r.claim for r in rows}) == 1 and {r.claim for r in rows} < claims


def test_duration_and_display(spark):
    from textloom.operators.report import duration_text

    df = spark.createDataFrame([(v,) for v in (-5.0, 59.9, 60.0, 3599.0, 3600.0, 90061.0)], "s double")
    assert [r[0] for r in df.select(duration_text(F.col("s"))).collect()] == ["0s", "59s", "1m 00s", "59m 59s", "1h 00m 00s", "25h 01m 01s"]
    row = spark.range(1).select(logs.display_row(F.lit(12), F.lit(1.23456), F.lit(0.0), F.lit(0.5), F.lit(0.256))).first()[0]
    assert row == f"  step {12:<6}  loss {1.23456:<8.4f}  lr {'0':<10}  gnorm {0.5:<8.3f}  ep {0.256:.2f}"


def test_large_vocabulary_is_joined(spark, monkeypatch):
    """A vocabulary beyond the lookup's size keeps every id."""
    df = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a a zz"), (3, ""), (4, "h g f")], "id int, text string")
    vocab = tokens.vocabulary(df.where("id <> 2"), "text", 100)
    want = {r.id: r.input_ids for r in tokens.tokenize(df, "text", vocab, 6).collect()}
    monkeypatch.setattr(tokens, "LOOKUP_ROWS", 4)
    got = {r.id: r.input_ids for r in tokens.tokenize(df, "text", vocab, 6).collect()}
    assert got == want and len(set(want[1])) == 6 and want[2][-1] == 3


def test_images_of_all_kinds(spark):
    png = bytes.fromhex("89504E470D0A1A0A00")
    rows = [(1, (png, None), "a.PNG", png, 1), (2, (b"xx", "a.png"), "a.txt", b"xx", 0), (3, (None, "a.jpeg"), None, None, 2),
            (4, (b"", "b"), "x/b.tiff", b"", 3), (5, None, "", png, 4)]
    df = spark.createDataFrame(rows, "id int, s struct<bytes:binary,path:string>, p string, b binary, label int")
    for image, want in (("s", {1, 3}), ("p", {1, 4}), ("b", {1, 5})):
        assert {r.id for r in prepare.drop_unreadable(df, image).collect()} == want
    out = prepare.prepare(df.select("id", F.col("b").alias("photo"), "label"), "id", clean_mode="code").collect()
    assert {(r.id, r.text) for r in out} == {(1, "1"), (5, "4")}
    zero = prepare.prepare(df.select("id", F.col("s").alias("img"), F.lit(0.0).alias("label"), F.lit("what").alias("question")), "id").collect()
    assert {(r.id, r.text) for r in zero} == {(1, "what"), (3, "what")}


def test_message_arrays(spark):
    rows = [(1, [("user", "hello  there"), ("assistant", "hi <b>you</b>")], None), (2, [("user", "")], None), (3, None, "x")]
    df = spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>, extra string")
    for forced in (None, "chat"):
        assert {(r.id, r.text) for r in prepare.prepare(df, "id", "code", forced).collect()} == {(1, "hello  there\n\nhi you")}


def test_lines_with_text_behind_an_object(spark):
    lines = ['{"loss": 1, "m": {"k": 2}} 5%|', '{"loss": 2, "m": {"k": 2}}', '{"loss": NaN, "step": 3}', '{"loss": -Infinity, "eval_runtime": 2.5}',
             "5%| {'loss': 4} it", '{"loss": 5} tail', "{'loss': 6, 'm': {'k': 2}} tail"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id int, value string")
    got = {r.id: (repr(r.loss), r.eval_runtime) for r in logs.entry_fields(logs.parse_lines(df)).collect()}
    assert got == {1: ("2.0", None), 2: ("nan", None), 3: ("-inf", 2.5), 4: ("4.0", None), 5: ("5.0", None)}
