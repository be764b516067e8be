"""Three genomes with one insertion and one deletion, from files to the published tables."""

import random

from pyspark.sql import functions as F

from lociweave.contracts import inputs as ic
from lociweave.contracts import results as rc
from lociweave.functions import keys as k
from lociweave.operators import graph as g
from lociweave.plans import catalogue as cat
from lociweave.sinks import text as sink
from lociweave.sources import genome as src
from lociweave.sources.text import numbered_lines, read_loose_table, read_table

PATHS = {"Ref": ("rp", "A+,B+,C+,D+"), "ins": ("ip", "A+,B+,C+,I+,D+"), "del": ("dp", "A+,C+,D+")}
CONTIG = {"Ref": "ref_c", "ins": "ins_c", "del": "del_c"}


def _files(tmp):
    rng = random.Random(11)
    seg = {n: "".join(rng.choice("ACGT") for _ in range(size)) for n, size in (("A", 1050), ("B", 100), ("C", 650), ("D", 3200))}
    seg["I"] = "CG" * 300
    lines = ["H\tVN:Z:1.0"] + [f"S\t{n}\t{s}" for n, s in seg.items()]
    lines += [f"L\t{a}\t+\t{b}\t+\t0M" for a, b in ("AB", "AC", "BC", "CD", "CI", "ID")]
    lines += [f"P\t{name}\t{path}\t*" for name, path in PATHS.values()]
    (tmp / "graph.gfa").write_text("\n".join(lines) + "\n")
    fasta = []
    for genome, (_, path) in PATHS.items():
        whole = "".join(seg[t[:-1]] for t in path.split(","))
        fasta.append(f">{genome}#0#{CONTIG[genome]}")
        fasta += [whole[i:i + 70] for i in range(0, len(whole), 70)]
    (tmp / "all.fa").write_text("\n".join(fasta) + "\n")
    calls = {"Ref": [(950, 1350)], "ins": [(950, 1350), (1900, 2200)], "del": [(950, 1250)]}
    for genome, spans in calls.items():
        rows = [f"{CONTIG[genome]}\t{a}\t{b}\tCGI\t{b - a}\t20\t100\t{200 * 20 / (b - a)!r}\t{100 * 100 / (b - a)!r}\t1.0" for a, b in spans]
        (tmp / f"{genome}.bed").write_text("\n".join(rows) + "\n")
    head = "\t".join(src.EVENTS)
    (tmp / "ins.sv").write_text(f"{head}\nref_c\t1800\t1800\tnull\tINS\tins_c\t1800\t2400\t600\n")
    (tmp / "del.sv").write_text(f"{head}\nref_c\t1050\t1150\tNone\tDEL\tdel_c\t1050\t1050\t-100\n")

    def psl(fid, strand, size, a, b, blocks):
        n = sum(blocks)
        return "\t".join(map(str, [fid, n, 0, 0, 0, 0, 0, 0, 0, strand, "q", size, 0, size, "ref_c", 5000, a, b, len(blocks), ",".join(map(str, blocks)) + ",", "0,", "0,"]))

    hits = [psl("ins#0#ins_c:950-1350", "++", 400, 950, 1350, [400]), psl("del#0#del_c:950-1250", "++", 300, 950, 1350, [100, 200])]
    (tmp / "hits.psl").write_text("\n".join(hits) + "\n")
    return seg


def _inputs(spark, tmp):
    genomes = spark.createDataFrame([("Ref", "primary_reference"), ("ins", "sample"), ("del", "sample")], "genome string, role string")
    paths = spark.createDataFrame([(n, g_, CONTIG[g_]) for g_, (n, _) in PATHS.items()], "name string, genome string, contig string").select(
        k.path_id(F.lit("P"), [F.col("name")]).alias("gfa_path_id"), "genome", "contig"
    )
    lines = numbered_lines(spark, str(tmp / "graph.gfa"))
    walks = cat.walks_from_graph(lines, paths)
    beds, events = None, None
    for i, genome in enumerate(PATHS):
        bed = src.typed_bed(src.read_bed(spark, str(tmp / f"{genome}.bed"))).withColumns({"genome": F.lit(genome), "ordinal": F.lit(i * 10**6) + F.col("start0")})
        beds = bed if beds is None else beds.unionByName(bed)
    for genome in ("ins", "del"):
        ev = src.typed_events(src.read_events(spark, str(tmp / f"{genome}.sv"))).withColumn("genome", F.lit(genome))
        events = ev if events is None else events.unionByName(ev)
    from lociweave.operators.hits import hit_metrics

    hits = hit_metrics(src.read_psl(spark, str(tmp / "hits.psl")))
    chunks = src.read_fasta_lines(spark, str(tmp / "all.fa")).drop("line_no")
    return cat.Inputs(genomes, beds, walks, events, hits, chunks), lines, paths


def test_golden_example(spark, tmp_path):
    seg = _files(tmp_path)
    x, lines, paths = _inputs(spark, tmp_path)
    records = g.path_records(lines)
    inv = g.inventory(records)
    assert {r.overlap_status for r in inv.collect()} == {"requires_link_verification"}
    edges = g.edge_status(g.record_steps(records), g.link_table(g.links(lines)), "path_id", ("line_no", "pos"))
    assert {r.status for r in edges.collect()} == {"zero"}
    spans = {r.genome: r.n for r in x.walks.groupBy("genome").agg(F.max("end0").alias("n")).collect()}
    assert spans == {"Ref": 5000, "ins": 5600, "del": 4900}

    out = cat.build_catalogue(x)
    members = {r.fid: r for r in out["members"].collect()}
    assert {f: r.mechanism_class for f, r in members.items()} == {
        "Ref#0#ref_c:950-1350": "", "ins#0#ins_c:950-1350": "non-SV", "ins#0#ins_c:1900-2200": "INS-internal", "del#0#del_c:950-1250": "DEL-junction",
    }
    assert sorted(r.member_id for r in members.values()) == [f"M{i:09d}" for i in range(1, 5)]
    loci = {r.locus_id: r for r in out["loci"].collect()}
    assert {i: r.anchor_type for i, r in loci.items()} == {1: "primary_ref", 2: "nonref"}
    alleles = {r.public_id: r for r in out["alleles"].collect()}
    assert {i: r.locus_id for i, r in alleles.items()} == {"ins_ins_c:950:1350": 1, "del_del_c:950:1250": 1, "ins_ins_c:1900:2200": 2}
    assert alleles["ins_ins_c:950:1350"].member_n == 2
    locus = {(r.locus_id, r.genome): r.gt for r in out["locus_genotypes"].collect()}
    assert locus[1, "Ref"] == locus[1, "ins"] == locus[1, "del"] == locus[2, "ins"] == "1"
    assert locus[2, "Ref"] == locus[2, "del"] == "0"
    assert out["excluded"].count() == 0
    assert loci[2].ac == 1 and loci[2].n_called == 2 and loci[1].allele_mechanism_counts == '{"DEL-junction":1,"non-SV":1}'
    named = out["allele_genotypes"].select("locus_id", "genome", "gt")
    assert rc.closure_violations(out["locus_genotypes"], named).count() == 0

    sink.write_table(out["alleles"], str(tmp_path / "alleles"), ["public_id", "locus_id", "member_n", "mechanism_class"])
    back = read_loose_table(spark, str(tmp_path / "alleles"))
    assert sorted(r.public_id for r in back.collect()) == sorted(alleles)
    sink.write_fasta(out["allele_sequences"], str(tmp_path / "fasta"))
    again = {r.name: r.sequence for r in src.read_fasta(spark, str(tmp_path / "fasta")).collect()}
    assert again["ins_ins_c:1900:2200"] == seg["I"][100:400]


def test_input_contracts(spark, tmp_path):
    _files(tmp_path)
    lengths = spark.createDataFrame([("del_c", 4900)], "contig string, sequence_length long")
    assert ic.bed_violations(src.read_bed(spark, str(tmp_path / "del.bed")), lengths).count() == 0
    (tmp_path / "bad.bed").write_text("del_c\t10\t30\tx\t21\t4\t8\t40.0\t40.0\t1\ndel_c\t40\t60\tx\t20\t4\t8\t40.0\t41.0\t1\ndel_c\t40\t60\tx\t20\t4\t8\t40.0\t40\t1\nzz\t1\t2\tx\t1\t0\t0\t0\t0\t0\n")
    rules = {r.rule for r in ic.bed_violations(src.read_bed(spark, str(tmp_path / "bad.bed")), lengths).collect()}
    assert rules == {"bad_span", "percentage_contradicts_counts", "duplicate_interval", "unknown_sequence"}
    (tmp_path / "wrong.tsv").write_text("a\tb\n1\t2\n")
    try:
        read_table(spark, str(tmp_path / "wrong.tsv"), ["a", "c"])
        raise AssertionError("a wrong header must fail")
    except ValueError:
        pass
    rows = read_table(spark, str(tmp_path / "del.sv"), src.EVENTS).collect()
    assert rows[0].sv_id == "None"
