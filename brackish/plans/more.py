"""Further queries: tables by tool and rank, selections, reference building, evaluation, classifiers, ordination."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lineage as L
from ..operators import classify, ecology, evaluate, reference, tables
from . import views as V
from .register import query, r6

KM = "CASE WHEN length({0}) >= {1} THEN list_transform(range(1, length({0}) - {1} + 2), lambda i: substr({0}, i, {1})) ELSE [] END"
RUN = "coalesce(list_max(list_transform(regexp_extract_all({0}, 'A+|C+|G+|T+'), lambda x: length(x))), 0)"
REL = "rel AS (SELECT feature_id, sample, 100.0 * count / sum(count) OVER (PARTITION BY sample) AS pct FROM counts)"


def genus_lineage(s, d):
    """Lineages of six names, the last one of some an odd one."""
    lin = F.concat(F.array(F.lit("Root")), F.col("lineage"))
    odd = F.concat(F.slice(lin, 1, 5), F.array(F.concat(F.element_at(lin, -1), F.lit(" uncultured"))))
    return V.taxonomy(s, d).select("feature_id", F.when((F.col("feature_id") % 7 == 3) & (F.size(lin) == 6), odd).otherwise(lin).alias("lineage"))


GENUS = "gen AS (SELECT feature_id, CASE WHEN feature_id % 7 = 3 AND len(lineage) = 5 THEN list_concat(['Root'], list_concat(lineage[1:4], [lineage[5] || ' uncultured'])) ELSE list_concat(['Root'], lineage) END AS lineage FROM tax)"


@query("agg5_collapse", f"WITH {V.COUNTS}, {V.TAX}, {REL} SELECT taxon, sample, round(sum(pct), 6) AS pct FROM (SELECT sample, pct, coalesce(lineage[3], 'Unassigned') AS taxon FROM rel LEFT JOIN tax USING (feature_id)) WHERE taxon <> 'Unassigned' GROUP BY ALL")
def _(s, d):
    from ..operators import counts

    rel = counts.relative(V.counts(s, d))
    return tables.collapse(rel, V.taxonomy(s, d), "Class", drop_unassigned=True).withColumn("pct", r6("pct"))


@query("agg10_contig_summary", f"WITH {V.READS}, {V.COUNTS}, n AS (SELECT feature_id AS seq_id, sum(count)::BIGINT AS reads FROM counts GROUP BY 1), x AS (SELECT length(seq) AS n, length(regexp_replace(seq, '[ACGT]', '', 'g')) AS a, {RUN.format('seq')} AS p, coalesce(reads, 1) AS r FROM reads LEFT JOIN n USING (seq_id)), v AS (SELECT 'start' AS measure, 1 AS v FROM x UNION ALL SELECT 'end', n FROM x UNION ALL SELECT 'nbases', n FROM x UNION ALL SELECT 'ambigs', a FROM x UNION ALL SELECT 'polymer', p FROM x UNION ALL SELECT 'numseqs', r FROM x) SELECT measure, min(v) AS minimum, round_even(median(v), 0)::BIGINT AS median, round(avg(v), 2) AS mean, count(*) AS contigs FROM v GROUP BY 1")
def _(s, d):
    return tables.contig_summary(V.reads(s, d), V.counts(s, d))


@query("agg11_gapless_summary", f"WITH {V.READS}, x AS (SELECT length(seq) AS n, {RUN.format('seq')} AS p FROM reads), v AS (SELECT 'start' AS measure, 1 AS v FROM x UNION ALL SELECT 'end', n FROM x UNION ALL SELECT 'nbases', n FROM x UNION ALL SELECT 'ambigs', 0 FROM x UNION ALL SELECT 'polymer', p FROM x UNION ALL SELECT 'numseqs', 1 FROM x) SELECT measure, min(v) AS minimum, round_even(median(v), 0)::BIGINT AS median, round(avg(v), 2) AS mean, count(*) AS contigs FROM v GROUP BY 1")
def _(s, d):
    gapped = V.reads(s, d).withColumn("seq", F.concat(F.lit("..-"), F.substring("seq", 1, 10), F.lit("--"), F.expr("substring(seq, 11)"), F.lit(".")))
    return tables.contig_summary(gapped, strip_gaps=True)


@query("agg14_label_resolution", f"WITH {V.COUNTS}, {V.TAX}, {GENUS}, p AS (SELECT feature_id, sum(count)::BIGINT AS reads FROM counts GROUP BY 1), c AS (SELECT reads, lineage[6] AS g FROM p LEFT JOIN gen USING (feature_id)), l AS (SELECT reads, CASE WHEN trim(coalesce(g, '')) = '' THEN 'unclassified' WHEN contains(g, 'uncultured') THEN 'ambiguous' ELSE 'classified' END AS label FROM c), k AS (SELECT label, count(*) AS features, sum(reads)::BIGINT AS reads FROM l GROUP BY 1) SELECT label, coalesce(features, 0) AS features, coalesce(reads, 0) AS reads, round(100.0 * coalesce(features, 0) / sum(features) OVER (), 6) AS pct_features, round(100.0 * coalesce(reads, 0) / sum(reads) OVER (), 6) AS pct_reads FROM (VALUES ('classified'), ('ambiguous'), ('unclassified')) e(label) LEFT JOIN k USING (label)")
def _(s, d):
    return tables.label_resolution(V.counts(s, d), genus_lineage(s, d)).withColumns({c: r6(c) for c in ("pct_features", "pct_reads")})


@query("agg15_genus_buckets", f"WITH {V.TAX}, {GENUS} SELECT CASE WHEN len(lineage) < 6 THEN 'Classified (above genus)' WHEN contains(lineage[6], 'uncultured') THEN 'Classified (above genus)' ELSE lineage[6] END AS genus, count(*) AS n FROM gen GROUP BY 1")
def _(s, d):
    return genus_lineage(s, d).groupBy(tables.genus_bucket(F.col("lineage")).alias("genus")).agg(F.count("*").alias("n"))


TOOLS = "r AS (SELECT concat('t', feature_id % 3) AS tool, sample, coalesce(lineage[2], 'Unclassified') AS taxon, sum(count) AS n FROM counts JOIN tax USING (feature_id) GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY tool, sample) AS share FROM r)"


def by_tool(s, d):
    from pyspark.sql import Window

    rows = V.counts(s, d).join(V.taxonomy(s, d), "feature_id").groupBy(F.concat(F.lit("t"), (F.col("feature_id") % 3).cast("string")).alias("tool"), "sample", F.coalesce(F.try_element_at("lineage", F.lit(2)), F.lit(L.NONE)).alias("taxon")).agg(F.sum("count").alias("n"))
    return rows.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("tool", "sample")))


@query("agg16_recoded", f"WITH {V.COUNTS}, {V.TAX}, {TOOLS}, f AS (SELECT min(taxon) AS t FROM r WHERE taxon <> 'Unclassified') SELECT tool, CASE WHEN taxon = t THEN 'renamed' ELSE taxon END AS taxon, sum(n)::BIGINT AS n FROM r, f GROUP BY ALL")
def _(s, d):
    rows = by_tool(s, d)
    names = rows.where("taxon <> 'Unclassified'").agg(F.min("taxon").alias("old")).withColumn("new", F.lit("renamed"))
    return tables.recoded(rows, names).groupBy("tool", "taxon").agg(F.sum("n").alias("n"))


@query("agg17_composition", f"WITH {V.COUNTS}, {V.TAX}, {TOOLS}, k AS (SELECT tool, count(DISTINCT sample) AS k FROM p GROUP BY 1), m AS (SELECT tool, taxon, sum(share) / any_value(k) AS mean FROM p JOIN k USING (tool) GROUP BY ALL), top AS (SELECT taxon FROM m WHERE taxon <> 'Unclassified' GROUP BY 1 ORDER BY max(mean) DESC, taxon LIMIT 3), n AS (SELECT tool, taxon, coalesce(mean, 0) AS mean FROM k CROSS JOIN (SELECT taxon FROM top UNION ALL SELECT 'Unclassified') LEFT JOIN m USING (tool, taxon)) SELECT tool, taxon, round(mean, 6) AS mean FROM n UNION ALL SELECT tool, 'Other', round(greatest(1 - sum(mean), 0), 6) FROM n GROUP BY tool")
def _(s, d):
    return tables.composition(by_tool(s, d), 3).withColumn("mean", r6("mean"))


@query("agg23_alpha_by_group", f"WITH {V.COUNTS}, p AS (SELECT sample, count, count / sum(count) OVER (PARTITION BY sample) AS p FROM counts WHERE count > 0), a AS (SELECT sample, count(*)::DOUBLE AS richness, -sum(p * ln(p)) AS shannon, 1 / sum(p * p) AS inv_simpson FROM p GROUP BY 1), g AS (SELECT CASE WHEN CAST(substr(sample, 2) AS INT) % 2 = 0 THEN 'nose' ELSE 'pharynx' END AS site, * FROM a), l AS (UNPIVOT g ON richness, shannon, inv_simpson INTO NAME metric VALUE v) SELECT site, metric, round(median(v), 6) AS median, round(avg(v), 6) AS mean, round(min(v), 6) AS minimum, round(max(v), 6) AS maximum FROM l GROUP BY ALL")
def _(s, d):
    a = ecology.alpha(V.counts(s, d)).join(V.metadata(s, d), "sample").withColumn("richness", F.col("richness").cast("double"))
    return tables.metric_summary(a, ["richness", "shannon", "inv_simpson"], "site").withColumns({c: r6(c) for c in ("median", "mean", "minimum", "maximum")})


@query("set2_top_ids", f"WITH {V.COUNTS} SELECT DISTINCT feature_id FROM (SELECT feature_id, row_number() OVER (PARTITION BY sample ORDER BY count DESC, feature_id) AS r FROM counts) WHERE r <= 10")
def _(s, d):
    return tables.top_ids(V.counts(s, d), 10)


@query("set3_difference", f"WITH {V.COUNTS} SELECT feature_id FROM counts WHERE sample = 'S1' EXCEPT SELECT feature_id FROM counts WHERE sample = 'S2'")
def _(s, d):
    c = V.counts(s, d)
    return c.where("sample = 'S1'").select("feature_id").exceptAll(c.where("sample = 'S2'").select("feature_id")).distinct()


@query("set4_stacked", "SELECT doc_id AS id, lang, NULL::INT AS toxic FROM documents UNION ALL SELECT doc_id, NULL, toxic::INT FROM labels")
def _(s, d):
    a, b = V.table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang"), V.table(s, d, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    return tables.stacked(a, b)


@query("top2_ranked_text", f"WITH {V.COUNTS} SELECT sample, 0 AS line, '# ' || sample AS text FROM counts GROUP BY sample UNION ALL SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY count DESC, feature_id), feature_id::VARCHAR FROM counts")
def _(s, d):
    return tables.ranked_text(V.counts(s, d)).withColumn("line", F.col("line").cast("long"))


@query("top5_most_common", "WITH p AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL) SELECT user_id, event_type, n FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1")
def _(s, d):
    return tables.most_common(V.table(s, d, "events"), "user_id", "event_type", "event_id")


@query("cen1_first_n", "SELECT doc_id AS seq_id FROM documents ORDER BY doc_id LIMIT 100")
def _(s, d):
    return tables.first_n(V.reads(s, d).select("seq_id", F.col("seq_id").alias("ord")), 100).select("seq_id")


@query("srt3_newest", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def _(s, d):
    return tables.newest(V.table(s, d, "events").select("event_id", "ts"), "ts", 25)


@query("smp1_sample", "SELECT doc_id AS seq_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def _(s, d):
    return tables.sample_n(V.table(s, d, "documents").select(F.col("doc_id").alias("seq_id")), 50)


@query("smp3_split", "SELECT doc_id AS seq_id, ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 10 = 0 AS held_out FROM documents")
def _(s, d):
    return V.table(s, d, "documents").select(F.col("doc_id").alias("seq_id"), tables.held_out(F.col("doc_id")).alias("held_out"))


@query("seq19_with_genus", f"WITH {V.TAX} SELECT feature_id, lineage[5] AS \"Genus\" FROM tax WHERE lineage[5] IS NOT NULL")
def _(s, d):
    return tables.with_genus(V.taxonomy(s, d).select("feature_id", F.coalesce(F.try_element_at("lineage", F.lit(5)), F.lit(L.NONE)).alias("Genus")))


@query("seq20_without_empty", f"WITH {V.COUNTS}, h AS (SELECT feature_id, sample, count - 20 AS count FROM counts), k AS (SELECT * FROM h WHERE count > 0), t AS (SELECT *, sum(count) OVER (PARTITION BY sample) AS t FROM k) SELECT feature_id, sample, count FROM t WHERE t >= 100")
def _(s, d):
    return tables.without_empty(V.counts(s, d).withColumn("count", F.col("count") - 20), 100)


@query("jn11_shared_samples", f"WITH {V.COUNTS}, a AS (SELECT * FROM counts WHERE sample <> 'S3'), b AS (SELECT * FROM counts WHERE sample <> 'S5') SELECT 'a' AS t, sample, count(*) AS n FROM a WHERE sample IN (SELECT sample FROM b) GROUP BY ALL UNION ALL SELECT 'b', sample, count(*) FROM b WHERE sample IN (SELECT sample FROM a) GROUP BY ALL")
def _(s, d):
    c = V.counts(s, d)
    a, b = tables.shared_samples(c.where("sample <> 'S3'"), c.where("sample <> 'S5'"))
    n = lambda t, x: t.groupBy("sample").agg(F.count("*").alias("n")).select(F.lit(x).alias("t"), "sample", "n")
    return n(a, "a").union(n(b, "b"))


@query("jn13_training_join", "WITH a AS (SELECT doc_id FROM documents WHERE doc_id % 5 <> 0), b AS (SELECT doc_id FROM labels) SELECT count(*) FILTER (WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL) AS matched, count(*) FILTER (WHERE b.doc_id IS NULL) AS without_taxonomy, count(*) FILTER (WHERE a.doc_id IS NULL) AS without_sequence FROM a FULL JOIN b ON a.doc_id = b.doc_id")
def _(s, d):
    seqs = V.table(s, d, "documents").where("doc_id % 5 <> 0").select(F.col("doc_id").alias("seq_id"))
    return tables.training_join(seqs, V.table(s, d, "labels").select(F.col("doc_id").alias("seq_id")))[1]


@query("jn16_renamed", "SELECT concat('run', n_nationkey) AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 20 GROUP BY 1")
def _(s, d):
    names = V.table(s, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("old"), F.concat(F.lit("run"), "n_nationkey").alias("new"))
    return tables.renamed(V.table(s, d, "customer").select(F.col("c_nationkey").cast("string").alias("nation")), names.union(names), "nation").groupBy("nation").agg(F.count("*").alias("n"))


@query("win4_running_cap", "WITH g AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents), p AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM g WHERE r <= 5) SELECT doc_id FROM p WHERE r <= 12")
def _(s, d):
    refs = V.table(s, d, "documents").select("doc_id", F.col("lang").alias("phylum"), F.col("source").alias("genus"))
    return tables.capped(refs, 5, 12, "doc_id").select("doc_id")


DOMAIN = {"en": "Bacteria", "de": "Archaea", "fr": "Eukaryota"}
DOMAIN_SQL = "CASE string_split(lineage, ';')[2] " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DOMAIN.items()) + " ELSE 'Other' END"


@query("seq7_reference_qc", f"WITH {V.REFS}, x AS (SELECT seq, {DOMAIN_SQL} AS dom FROM refs), j AS (SELECT CASE WHEN dom = 'Other' THEN 'domain' WHEN length(seq) < 50 THEN 'short' WHEN length(seq) < CASE dom WHEN 'Archaea' THEN 900 WHEN 'Bacteria' THEN 1200 ELSE 1400 END THEN 'length' WHEN regexp_matches(seq, 'A{{9,}}|C{{9,}}|G{{9,}}|T{{9,}}') THEN 'homopolymer' ELSE 'kept' END AS reason FROM x) SELECT reason, count(*) AS n FROM j GROUP BY 1")
def _(s, d):
    dom = F.lit("Other")
    for k, v in DOMAIN.items():
        dom = F.when(F.split("lineage", ";")[1] == k, v).otherwise(dom)
    refs = V.refs(s, d).select("seq_id", F.translate("seq", "T", "U").alias("seq"), F.concat(dom, F.lit(";x")).alias("lineage"))
    return reference.reasons(reference.judged(refs))


@query("seq12_trim_to_span", f"WITH {V.READS}, s AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM (SELECT doc_id, 3 + toxic AS a, 60 AS b FROM labels UNION ALL SELECT doc_id, 5, 80 - 100 * quality FROM labels) GROUP BY 1) SELECT seq_id, substr(seq, a, b - a + 1) AS seq FROM reads JOIN s ON doc_id = seq_id WHERE b >= a")
def _(s, d):
    lab = V.table(s, d, "labels")
    spans = lab.select(F.col("doc_id").alias("query_id"), (3 + F.col("toxic")).cast("int").alias("start"), F.lit(60).alias("end")).union(lab.select("doc_id", F.lit(5), (80 - 100 * F.col("quality")).cast("int")))
    return reference.trim_to_span(V.reads(s, d), spans).select("seq_id", "seq")


@query("drp5_consensus", f"WITH {V.REFS}, k AS (SELECT seq, string_split(lineage, ';') AS l, count(*) AS n, min(seq_id) AS f FROM refs GROUP BY ALL), g AS (SELECT seq, min(f) AS seq_id, sum(n)::BIGINT AS copies, max(n) AS most, count(*) AS kinds, arg_max(l, n) AS common, count(DISTINCT l[1:1]) AS c1, count(DISTINCT l[1:2]) AS c2, count(DISTINCT l[1:3]) AS c3, count(DISTINCT l[1:4]) AS c4 FROM k GROUP BY seq) SELECT seq_id, copies, kinds > 1 AS conflict, array_to_string(CASE WHEN most / copies >= 0.9 THEN common ELSE list_slice(common, 1, (c1 = 1)::INT + (c2 = 1)::INT + (c3 = 1)::INT + (c4 = 1)::INT) END, ';') AS lineage FROM g")
def _(s, d):
    refs = V.refs(s, d).select("seq_id", "seq", F.split("lineage", ";").alias("lineage"), F.col("seq_id").alias("ord"))
    return reference.consensus(refs).select("seq_id", "copies", "conflict", F.array_join("lineage", ";").alias("lineage"))


@query("fn_norm2_rooted", "SELECT doc_id, concat('Root;', lang, ';', source) AS lineage FROM documents")
def _(s, d):
    raw = F.concat(F.when(F.col("doc_id") % 2 == 0, "Root;").otherwise(F.lit(";")), "lang", F.lit("(100);"), "source", F.lit("(87);"))
    return V.table(s, d, "documents").select("doc_id", reference.rooted(raw).alias("lineage"))


@query("src26_header", "SELECT concat('AB', doc_id, '_1_99') AS seq_id, concat('Bacteria;', lang) AS lineage FROM documents")
def _(s, d):
    h = F.concat(F.lit(">AB"), "doc_id", F.lit(".1.99 Bacteria;"), "lang")
    return V.table(s, d, "documents").select(reference.id_and_lineage(h).alias("h")).select("h.*")


@query("src27_header", "SELECT concat('HM:tax_', doc_id) AS seq_id FROM documents")
def _(s, d):
    h = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(">HM:tax_"), "doc_id", F.lit(" | Some name | gene"))).otherwise(F.concat(F.lit(">HM:tax_"), "doc_id", F.lit("  Some name")))
    return V.table(s, d, "documents").select(reference.piped_id(h).alias("seq_id"))


@query("cls23_species_lineage", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR doc_id % 10 < 4 THEN 'unclassified;' WHEN doc_id % 2 = 0 THEN concat('A;', lang, ';') ELSE concat('unknown_domain;unknown_phylum;unknown_class;unknown_order;unknown_family;', lang, ';', lang, '_', source, ';') END AS lineage FROM documents")
def _(s, d):
    species = F.when(F.col("doc_id") % 5 == 0, "AMBIGUOUS").otherwise(F.concat("lang", F.lit("_"), "source"))
    lin = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("A;"), "lang", F.lit(";")))
    share = F.when(F.col("doc_id") % 10 < 4, 0.4).otherwise(0.5)
    return V.table(s, d, "documents").select("doc_id", reference.species_lineage(species, share, lin).alias("lineage"))


@query("idx2_share_index", f"WITH {V.REFS}, k AS (SELECT lineage, unnest({KM.format('seq', 5)}) AS kmer FROM refs), p AS (SELECT kmer, lineage, count(*) AS n FROM k GROUP BY ALL) SELECT kmer, lineage, round(n / sum(n) OVER (PARTITION BY kmer), 9) AS weight FROM p")
def _(s, d):
    return reference.share_index(classify.postings(V.refs(s, d), 5)).withColumn("weight", F.round("weight", 9))


MINI = f"k AS (SELECT DISTINCT lineage, unnest({KM.format('seq', 12)}) AS kmer FROM refs), mi AS (SELECT DISTINCT lineage, list_min(list_transform(range(1, 4), lambda i: substr(kmer, i, 10))) AS minimizer FROM k)"


@query("idx2_minimizer_index", f"WITH {V.REFS}, {MINI} SELECT minimizer, lineage FROM mi")
def _(s, d):
    return reference.minimizer_index(classify.postings(V.refs(s, d), 12), 12, 10)


@query("cls14_minimizer_classify", f"WITH {V.REFS}, {MINI}, qk AS (SELECT DISTINCT seq_id, unnest({KM.format('seq', 12)}) AS kmer FROM reads), q AS (SELECT DISTINCT seq_id, list_min(list_transform(range(1, 4), lambda i: substr(kmer, i, 10))) AS minimizer FROM qk), j AS (SELECT DISTINCT seq_id, string_split(lineage, ';') AS l FROM q JOIN mi USING (minimizer)), g AS (SELECT seq_id, any_value(l) AS l, (count(DISTINCT l[1:1]) = 1)::INT + (count(DISTINCT l[1:2]) = 1)::INT + (count(DISTINCT l[1:3]) = 1)::INT + (count(DISTINCT l[1:4]) = 1)::INT AS n FROM j GROUP BY 1) SELECT seq_id, coalesce(array_to_string(list_slice(l, 1, n), ';'), 'Unclassified') AS lineage FROM reads LEFT JOIN g USING (seq_id)")
def _(s, d):
    return reference.minimizer_lca_classify(V.reads(s, d), reference.lca_index(V.refs(s, d), 12, 10), 12, 10)


@query("cls8_lca_classify", f"WITH {V.REFS}, k AS (SELECT string_split(lineage, ';') AS l, unnest({KM.format('seq', 10)}) AS kmer FROM refs), c AS (SELECT kmer, any_value(l) AS l, (count(DISTINCT l[1:1]) = 1)::INT + (count(DISTINCT l[1:2]) = 1)::INT + (count(DISTINCT l[1:3]) = 1)::INT + (count(DISTINCT l[1:4]) = 1)::INT AS n FROM k GROUP BY 1), q AS (SELECT seq_id, unnest({KM.format('seq', 10)}) AS kmer FROM reads), v AS (SELECT seq_id, list_slice(l, 1, n) AS l, count(*) AS n FROM q JOIN c USING (kmer) GROUP BY ALL), x AS (SELECT seq_id, i AS lv, array_to_string(list_slice(l, 1, i + 1), ';') AS p, sum(n) AS v FROM v, range(1, 4) r(i) WHERE len(l) > i GROUP BY ALL), b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY seq_id, lv ORDER BY v DESC, p) = 1), w AS (SELECT seq_id, max(p) FILTER (WHERE lv = 1) AS p1, max(p) FILTER (WHERE lv = 2) AS p2, max(p) FILTER (WHERE lv = 3) AS p3, max(v) FILTER (WHERE lv = 2) AS v2, max(v) FILTER (WHERE lv = 3) AS v3 FROM b GROUP BY 1) SELECT seq_id, coalesce(CASE WHEN p3 IS NOT NULL AND v3 / (v2 + 1e-9) > 0.85 THEN p3 ELSE coalesce(p2, p1) END, 'Unclassified') AS lineage FROM reads LEFT JOIN w USING (seq_id)")
def _(s, d):
    return reference.lca_classify(V.reads(s, d), reference.lca_index(V.refs(s, d), 10), 10)


CALLS = "t AS (SELECT feature_id, [p_type, p_brand, concat('size', p_size), p_name] AS truth, lineage AS cut FROM tax JOIN part ON p_partkey = feature_id), calls AS (SELECT c.conf, t.truth, feature_id % 3 > 0 AS known, CASE WHEN len(cut) < 2 THEN []::VARCHAR[] WHEN feature_id % 11 = 0 THEN list_concat(list_slice(cut, 2, len(cut) - 1), ['odd']) ELSE list_slice(cut, 2, CASE WHEN c.conf = 80 AND feature_id % 2 = 0 THEN 3 ELSE 9 END) END AS got FROM t, (VALUES (60), (80)) c(conf)), o AS (SELECT *, CASE WHEN len(got) = 0 THEN 'unclassified' WHEN len(got) >= 4 THEN CASE WHEN list_slice(got, 1, 4) = truth THEN 'genus_ok' ELSE 'genus_wrong' END WHEN list_slice(truth, 1, len(got)) = got THEN 'above_ok' ELSE 'above_wrong' END AS o FROM calls)"


def calls(s, d):
    part = V.table(s, d, "part").select(F.col("p_partkey").alias("feature_id"), F.array("p_type", "p_brand", F.concat(F.lit("size"), "p_size"), "p_name").alias("truth"))
    t = part.join(V.taxonomy(s, d), "feature_id").withColumn("conf", F.explode(F.array(F.lit(60), F.lit(80))))
    n = F.size("lineage")
    got = F.when(n < 2, F.array().cast("array<string>")).when(F.col("feature_id") % 11 == 0, F.concat(F.slice("lineage", F.lit(2), n - 2), F.array(F.lit("odd")))).otherwise(F.slice("lineage", F.lit(2), F.when((F.col("conf") == 80) & (F.col("feature_id") % 2 == 0), 2).otherwise(8)))
    return t.select("conf", "truth", (F.col("feature_id") % 3 > 0).alias("known"), got.alias("got"))


@query("evl1_hold_out", f"WITH {V.TAX}, {CALLS}, g AS (SELECT conf, count(*) FILTER (WHERE known) AS nk, count(*) FILTER (WHERE NOT known) AS nn, count(*) FILTER (WHERE known AND o = 'genus_ok') AS a, count(*) FILTER (WHERE known AND o = 'genus_wrong') AS b, count(*) FILTER (WHERE known AND o LIKE 'above%') AS c, count(*) FILTER (WHERE known AND o = 'unclassified') AS e, count(*) FILTER (WHERE NOT known AND o = 'genus_wrong') AS f FROM o GROUP BY 1) SELECT conf, nk AS n_known, round(100.0 * a / nk, 6) AS genus_ok_pct, round(100.0 * b / nk, 6) AS genus_wrong_pct, round(100.0 * c / nk, 6) AS above_genus_pct, round(100.0 * e / nk, 6) AS unclassified_pct, nn AS n_novel, round(100.0 * f / nn, 6) AS novel_false_genus_pct FROM g")
def _(s, d):
    out = evaluate.hold_out(calls(s, d), ["conf"], genus=4)
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_pct")})


@query("evl2_error_kinds", f"WITH {V.TAX}, {CALLS} SELECT CASE WHEN contains(truth[4], '7') THEN 'ambiguous truth' ELSE 'real error' END AS kind, count(*) AS n FROM o WHERE o = 'genus_wrong' GROUP BY 1")
def _(s, d):
    return evaluate.error_kinds(calls(s, d), "7", genus=4)


@query("evl3_concordance", f"WITH {V.TAX}, c AS (SELECT feature_id, lineage AS l, list_transform(range(1, len(lineage) + 1), lambda i: (feature_id * 7 + i * 13) % 101) AS x, list_transform(range(1, len(lineage) + 1), lambda i: (feature_id * 5 + i * 13) % 101) AS y, CASE WHEN feature_id % 4 = 0 THEN list_concat(list_slice(lineage, 1, len(lineage) - 1), ['odd']) ELSE lineage END AS m FROM tax), k AS (SELECT c.*, v.least, list_slice(l, 1, coalesce(list_min(list_filter(range(1, least(len(l), 4) + 1), lambda i: x[i] < v.least)), least(len(l), 4) + 1) - 1) AS a, list_slice(m, 1, coalesce(list_min(list_filter(range(1, least(len(l), 4) + 1), lambda i: y[i] < v.least)), least(len(l), 4) + 1) - 1) AS b FROM c, (VALUES (60), (70), (80), (90)) v(least)), z AS (SELECT *, a = b AS same, list_slice(a, 1, least(len(a), len(b))) = list_slice(b, 1, least(len(a), len(b))) AS branch FROM k) SELECT z.least, count(*) AS n, round(100.0 * count(*) FILTER (WHERE list_slice(l, 1, 4) = list_slice(m, 1, 4)) / count(*), 6) AS raw_pct, round(100.0 * count(*) FILTER (WHERE same) / count(*), 6) AS same_pct, round(100.0 * count(*) FILTER (WHERE branch AND NOT same) / count(*), 6) AS branch_pct, round(100.0 * count(*) FILTER (WHERE NOT branch) / count(*), 6) AS different_pct, round(100.0 * count(*) FILTER (WHERE same AND len(a) = 4) / count(*), 6) AS genus_pct FROM z GROUP BY 1")
def _(s, d):
    tax = V.taxonomy(s, d)
    conf = lambda names, k: F.transform(names, lambda t, i: F.struct(t.alias("taxon"), ((F.col("feature_id") * k + (i + 1) * 13) % 101).cast("int").alias("conf")))
    odd = F.when(F.col("feature_id") % 4 == 0, F.concat(F.slice("lineage", F.lit(1), F.size("lineage") - 1), F.array(F.lit("odd")))).otherwise(F.col("lineage"))
    a = tax.select(F.col("feature_id").alias("seq_id"), conf(F.col("lineage"), 7).alias("assignment"))
    b = tax.select(F.col("feature_id").alias("seq_id"), conf(odd, 5).alias("assignment"))
    out = evaluate.concordance(a, b, genus=4)
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_pct")})


@query("cls20_bayes", f"WITH {V.REFS}, c AS (SELECT string_split(lineage, ';')[2] AS label, kmer, count(*) AS n FROM (SELECT lineage, unnest({KM.format('seq', 6)}) AS kmer FROM refs) GROUP BY ALL), v AS (SELECT count(DISTINCT kmer) AS v FROM c), m AS (SELECT string_split(lineage, ';')[2] AS label, count(*) AS m FROM refs GROUP BY 1), t AS (SELECT label, sum(n) AS t FROM c GROUP BY 1), k AS (SELECT label, t, v, ln(m / sum(m) OVER ()) AS prior FROM t JOIN m USING (label), v), e AS (SELECT kmer, k.label, ln((coalesce(n, 0) + 1) / (t + v)) AS lp FROM (SELECT DISTINCT kmer FROM c) CROSS JOIN k LEFT JOIN c USING (kmer, label)), q AS (SELECT seq_id, kmer, count(*) AS n FROM (SELECT seq_id, unnest({KM.format('seq', 6)}) AS kmer FROM reads) GROUP BY ALL), s AS (SELECT seq_id, label, sum(n * lp) AS x FROM q JOIN e USING (kmer) GROUP BY ALL), f AS (SELECT r.seq_id, k.label, prior + coalesce(x, 0) AS score FROM reads r CROSS JOIN k LEFT JOIN s ON s.seq_id = r.seq_id AND s.label = k.label) SELECT seq_id, label FROM f QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY round(score, 6) DESC, label) = 1")
def _(s, d):
    refs = V.refs(s, d).select("seq", F.split("lineage", ";")[1].alias("label"))
    return classify.bayes_classify(V.reads(s, d), classify.bayes_train(refs)).select("seq_id", "label")


@query("cls22_hierarchical")
def _(s, d):
    names = F.split("lineage", ";")
    refs = V.refs(s, d).select("seq_id", "seq", names[1].alias("phylum"), names[2].alias("genus"))
    return classify.hierarchical(V.reads(s, d), refs)


@query("eco4_rarefaction_table")
def _(s, d):
    return ecology.rarefaction_table(V.counts(s, d), [100, 1000, 10_000_000])


@query("eco7_rarefied_means")
def _(s, d):
    return ecology.rarefied_means(V.counts(s, d), 1000, 200)


@query("eco12_nmds")
def _(s, d):
    names, m = ecology.matrix(ecology.bray_curtis(V.counts(s, d)))
    x, stress, kind = ecology.nmds(m)
    return s.createDataFrame([(n, float(a), float(b), stress, kind) for n, (a, b) in zip(names, x, strict=True)], "sample string, x double, y double, stress double, kind string")


@query("eco15_two_factors")
def _(s, d):
    names, m = ecology.matrix(ecology.bray_curtis(V.counts(s, d)))
    site = dict(V.metadata(s, d).collect())
    factors = {"site": [site[n] for n in names], "third": [int(n[1:]) % 3 for n in names]}
    rows = [(how, k, v["df"], v["F"], v["R2"], v["p"]) for how, b in (("free", None), ("blocks", factors["third"])) for k, v in ecology.marginal_permanova(m, factors, blocks=b).items()]
    return s.createDataFrame(rows, "permuted string, term string, df long, f double, r2 double, p double")


@query("eco14_dispersion_test")
def _(s, d):
    names, m = ecology.matrix(ecology.bray_curtis(V.counts(s, d)))
    site = dict(V.metadata(s, d).collect())
    t = ecology.dispersion_test(m, [site[n] for n in names])
    return s.createDataFrame([(float(t["F"]), float(t["p"]))], "f double, p double")


@query("eco20_ellipse_parameters", "WITH a AS (SELECT label, avg(embedding[1]) AS mx, avg(embedding[2]) AS my, corr(embedding[1], embedding[2]) AS r, stddev_samp(embedding[1]) AS sx, stddev_samp(embedding[2]) AS sy FROM embeddings GROUP BY 1) SELECT label, round(mx, 6) AS mx, round(my, 6) AS my, round(r, 6) AS pearson, round(sqrt(1 + r), 6) AS radius_x, round(sqrt(1 - r), 6) AS radius_y, round(2.4477 * sx, 6) AS scale_x, round(2.4477 * sy, 6) AS scale_y FROM a")
def _(s, d):
    points = V.table(s, d, "embeddings").select("label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    out = ecology.ellipse(points, "label")
    return out.withColumns({c: r6(c) for c in out.columns if c != "label"})


@query("eco22_qa_report")
def _(s, d):
    r = V.reads(s, d).select("sample", F.length("seq").alias("n"))
    steps = r.agg(F.lit("length").alias("step"), F.count("*").alias("before"), F.count_if(F.col("n") >= 200).alias("after"))
    bands = s.createDataFrame([("V4",)], "marker string")
    return ecology.qa_report(steps, r, bands)
