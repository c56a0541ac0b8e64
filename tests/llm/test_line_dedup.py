import random
import time

from tessera.llm.line_dedup import dedup_lines, line_components, removed_lines

SCHEMA = "doc_id long, text string"


def shingles(x, size=5):
    return {x[k:k + size] for k in range(max(1, len(x) - size + 1))}


def brute(rows):
    """Texts after dropping all but the first line of each component."""
    places = {}
    for d, t in rows:
        for n, line in enumerate(t.split("\n")) if t is not None else ():
            x = line.lower().strip(" ")
            if x:
                places.setdefault(x, set()).add((d is None, d or 0, n))
    lines = list(places)
    sets = [shingles(x) for x in lines]
    root = list(range(len(lines)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(lines)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c >= 0.8 * (len(sets[i]) + len(sets[j]) - c) - 1e-9:
                root[find(i)] = find(j)
    comps = {}
    for k, x in enumerate(lines):
        comps.setdefault(find(k), set()).update(places[x])
    stay = {min(v) for v in comps.values()}
    return [(d, None if t is None else "\n".join(
        line for n, line in enumerate(t.split("\n")) if not line.strip(" ") or (d is None, d or 0, n) in stay)) for d, t in rows]


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    words = [f"{a}{b}{c}" for a in ("lor", "ips", "dol", "sit", "amet") for b in ("um", "or", "an", "ix") for c in ("a", "us", "ent")]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(6, 60))) for _ in range(30)]
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(base) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))
            if rng.random() < 0.3:
                w = line.split()
                w[rng.randrange(len(w))] = rng.choice(words)
                line = " ".join(w)
            lines.append(rng.choice(["", "  "]) + (line.upper() if rng.random() < 0.1 else line))
        if d % 7 == 0:
            lines += ["", "ok", "Boilerplate line of the site", ""]
        rows.append((d, "\n".join(lines)))
    return rows


def test_equals_brute_force(spark):
    rows = corpus() + [(60, None), (61, ""), (62, "\n\n"), (63, "x"), (64, "long " * 20_000), (65, "long " * 20_000 + "\nX")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "'s' as source", "text", "1 as id", "2 as removed", "3 as gone_id", "4 as `row`", "5 as no")
    out = dedup_lines(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.orderBy("doc_id").collect()]
    assert got == brute(rows)
    assert got != rows


def test_ties_repeated_rows_null_ids_and_empty(spark):
    rows = [(3, "same line here\nother"), (3, "same line here\nother"), (2, "Same line here "), (None, "other\nsame line here\nnew"), (5, "dup dup dup\ndup dup dup")]
    out = dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == [
        ("2", "Same line here "), ("3", "other"), ("3", "other"), ("5", "dup dup dup"), ("None", "new")]
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_lines(empty).collect() == [] and removed_lines(empty).collect() == []


def test_components_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(corpus(3), SCHEMA)
    a = line_components(df.repartition(2), "doc_id", "text").collect()
    b = line_components(df.repartition(9), "doc_id", "text", broadcast_rows=0).collect()
    assert sorted(a) == sorted(b) and a


def test_main_path_has_no_python(spark):
    plan = dedup_lines(spark.createDataFrame(corpus(4), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_bitmaps_never_rule_out_similar_lines(spark):
    from pyspark.sql import functions as F

    from tessera.llm.line_dedup import BITMAP, _bitmap, _may_be_similar
    rng = random.Random(5)
    rows = []
    for p in range(3000):
        n = rng.choice([1, 4, 9, 40, 400, 2000])
        g = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
        cut = rng.randrange(n + 1) if p % 2 else n - n // 10  # half of them at 0.8 or a little more
        rows += [(p, 0, x) for x in g] + [(p, 1, x) for x in g[:cut]] + [(p, 1, rng.getrandbits(62)) for _ in range(n // 10 if p % 4 == 0 else 0)]
    sets = spark.createDataFrame(rows, "pair long, side int, g long").groupBy("pair", "side").agg(
        F.count("*").alias("size"), F.collect_set("g").alias("g"), *_bitmap(F.col("g")))
    a = sets.where("side = 0")
    b = sets.where("side = 1").select("pair", F.col("size").alias("size_b"), F.col("g").alias("h"), *[F.col(f"b{k}").alias(f"c{k}") for k in range(BITMAP)])
    both = F.size(F.array_intersect("g", "h"))
    out = a.join(b, "pair").select((both >= 0.8 * (F.size("g") + F.size("h") - both) - 1e-9).alias("similar"),
                                   _may_be_similar(0.8).alias("kept")).groupBy("similar", "kept").count().collect()
    counts = {(r["similar"], r["kept"]): r["count"] for r in out}
    assert (True, False) not in counts and counts[True, True] > 500 and counts[False, False] > 500


def test_a_document_that_loses_very_many_lines(spark):
    import time
    lines = [f"line number {k} of the long list {k * 7919 % 10007}" if k % 2 else "the very same line again" for k in range(30_000)]
    began = time.time()
    got = dedup_lines(spark.createDataFrame([(1, "\n".join(lines))], SCHEMA)).first()["text"].split("\n")
    assert got.count("the very same line again") == 1 and time.time() - began < 240


def test_eager_jobs_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}

    before = shuffled()
    rows = [(k, f"line number {k % 7} of the text\nanother one, {k // 2}") for k in range(60)]
    gone = removed_lines(spark.createDataFrame(rows, SCHEMA))
    end = time.time() + 10
    while shuffled() - before and time.time() < end:  # executors delete them soon after the job
        time.sleep(0.2)
    assert shuffled() <= before
    assert gone.count()
