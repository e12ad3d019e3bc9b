"""Pipelines on small literal inputs."""

import json

from pyspark.sql import functions as F

from fieldloom.operators import html
from fieldloom.plans import checklists, genomes, occurrences
from fieldloom.sources import readers


def table(spark, names, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{n}` string" for n in names.split(",")))


def landed(spark, tmp_path, name, value):
    (tmp_path / name).write_text(json.dumps(value))
    return readers.read_json_array(spark, str(tmp_path / name))


def test_fauna(spark):
    names = [*checklists.FAUNA_DROPPED, *checklists.FAUNA_NAMES, *checklists.FAUNA_TITLES, "SCIENTIFIC_NAME", "FAMILY", "GENUS", "SUBGENUS", "SPECIES", "SUBSPECIES", "NAMES_VARIOUS", "AUTHOR", "YEAR", "ORIG_COMBINATION", "QUALIFICATION"]

    def row(**k):
        return [k.get(n, "t" if n in checklists.FAUNA_TITLES else None) for n in names]

    base = {"NAME_TYPE": "Valid Name", "RANK": "Species", "TAXON_GUID": "1", "SCIENTIFIC_NAME": "Aus bus", "GENUS": "Aus", "SUBGENUS": "Cus", "SPECIES": "bus", "AUTHOR": "L.", "YEAR": "1758.0", "ORIG_COMBINATION": "N", "FAMILY": "Fam"}
    doubtful = base | {"RANK": "Species Inquirenda", "NAME_TYPE": "Synonym", "TAXON_GUID": "2", "FAMILY": None}
    rows = [row(**base), row(**doubtful), row(**(doubtful | {"NAME_TYPE": "Valid Name", "FAMILY": "Twin"})), row(**(base | {"SCIENTIFIC_NAME": "Unplaced Synonym(s)"})), row(**(base | {"RANK": "Genus", "NAMES_VARIOUS": "Aus", "PARENT_TAXON_GUID": "2", "AUTHOR": None}))]
    out = checklists.afd_cleanup(table(spark, ",".join(names), *rows), "D:1").collect()
    by = {(r.taxon_id, r.taxon_rank): r for r in out}
    assert len(out) == 3
    one = by["1", "Species"]
    assert (one.canonical_name, one.year, one.authorship, one.scientific_name_authorship, one.published_media_title) == ("Aus (Cus) bus", "1758", "L., 1758", "(L., 1758)", "ttt")
    assert one.entity_id == "D:1;Aus bus;Valid Name"
    assert (by["2", "Species"].family, by["2", "Species"].qualification, by["2", "Species"].taxonomic_status) == ("Twin", "species inquirendum", "Valid Name")
    assert (by["1", "Genus"].canonical_name, by["1", "Genus"].authorship) == ("Aus", "")


def test_fauna_parents_and_pages(spark):
    df = table(spark, "taxon_id,parent_taxon_id,scientific_name,taxon_rank,taxonomic_status,canonical_name", "1,,Aus,Genus,Valid Name,Aus".split(","), "2,1,Aus bus,Species,Valid Name,Aus bus".split(","), "2,1,Old,Species,Synonym,Old".split(","), "3,1,No,Species,Other,No".split(","))
    out = {r.scientific_name: r for r in checklists.afd_parents(df).collect()}
    assert set(out) == {"Aus", "Aus bus", "Old"}
    assert (out["Old"].parent_taxon, out["Old"].accepted_usage_taxon) == ("Aus", "Aus bus")
    pages = table(spark, "taxon_id,rank,name,html", ("2", "species", "Aus bus", "<h3>Places</h3><ul><li>North</li><li>South</li></ul>"))
    rich = {r.scientific_name: r.places_species for r in checklists.afd_enrich(df, pages, {"places": "Places"}).collect()}
    assert rich == {"Aus": None, "Aus bus": "North|South", "Old": None, "No": None}


def test_tree_of_blocks(spark):
    nodes = spark.createDataFrame([(1, None, False, "K"), (2, 1, True, "P"), (3, 1, False, "Q"), (4, 3, True, "R"), (5, 2, True, "below")], "key int, parent int, has_block boolean, rank string")
    blocks = spark.createDataFrame([(2, "a"), (4, "b"), (5, "c")], "block_key int, name string")
    assert {(r.name, r.higher_ranks) for r in checklists.afd_collect(nodes, blocks).collect()} == {("a", "K;P"), ("b", "K;Q;R")}


def test_taxonomy_dump(spark):
    cols = "tax_id,parent_tax_id,division_id,inherited_div_flag,genetic_code_id,inherited_GC_flag,mitochondrial_genetic_code_id,inherited_MGC_flag,GenBank_hidden_flag,hidden_subtree_root_flag"
    nodes = table(spark, cols, "1,1,0,0,1,0,5,0,0,0".split(","), "2,1,9,1,9,1,9,1,0,0".split(","), "3,2,9,1,2,0,9,1,0,0".split(","))
    names = spark.createDataFrame([("2", "Aus bus", "scientific name", 1), ("2", "Aus bus (L.)", "authority", 2), ("2", "s1", "synonym", 3), ("2", "s2", "synonym", 4)], "tax_id string, name_txt string, name_class string, line_no int")
    divisions = table(spark, "division_id,division_cde,division_name,comments", ("0", "INV", "Invertebrates", ""))
    out = {r.tax_id: r for r in checklists.taxonomy(nodes, names, divisions, ["scientific name", "authority", "synonym", "in-part"], {"curated": False}).collect()}
    assert (out["2"].division_id, out["3"].genetic_code_id, out["3"].mitochondrial_genetic_code_id, out["2"].nomenclatural_code) == ("0", "2", "5", "ICZN")
    assert (out["2"].authority, out["2"].synonym, out["2"].scientific_name, out["1"].authority, out["2"].curated) == ("L.", "s2", "Aus bus", "", False)


def test_integrated_taxonomy(spark):
    units = table(spark, ",".join(["tsn", "parent_tsn", "complete_name", "kingdom_id", "rank_id", "taxon_author_id", "hybrid_author_id", *checklists.UNIT_PARTS]), ("1", "0", "Aus", "5", "10", "7", "8", *"x" * 9), ("2", "1", "Old", "5", "10", None, None, *"x" * 9))
    out = {r.tsn: r for r in checklists.itis(units, table(spark, "kingdom_id,kingdom_name", ("5", "Animalia")), table(spark, "kingdom_id,rank_id,rank_name", ("5", "10", "Genus")), table(spark, "taxon_author_id,taxon_author,kingdom_id", ("7", "L.", "5"), ("8", "H.", "5")), table(spark, "tsn,tsn_accepted", ("2", "1")), "D").collect()}
    assert (out["1"].taxon_author, out["1"].hybrid_author, out["1"].rank_name, out["1"].taxonomic_status, out["1"].entity_id) == ("L.", "H.", "Genus", "valid name", "D1")
    assert (out["2"].accepted_name, out["2"].taxonomic_status, out["2"].parent_tsn) == ("Aus", "synonym", 1)


def test_smaller_checklists(spark):
    census = checklists.apc_denormalize(table(spark, "taxonID,scientificName,taxonRank,parentNameUsageID", ("1", "Aus", "[n/a]", None), ("2", "Aus bus", "Species", "1")))
    assert {r.taxon_id: r.parent_taxon for r in census.collect()} == {"1": None, "2": "Aus"}
    assert {r.taxon_rank for r in checklists.apc_cleanup(census, "D").collect()} == {"unranked", "Species"}
    found = checklists.col(table(spark, "dwc:taxonID,n", ("1", "a"), ("2", "b")), table(spark, "dwc:taxonID,p", ("1", "x")), table(spark, "dwc:taxonID,dcterms:language,dwc:vernacularName", ("1", "eng", "B"), ("1", "eng", "A")), ["eng", "deu"])
    assert {r[0]: (r.p, r.eng, r.deu) for r in found.collect()} == {"1": ("x", ["A", "B"], None), "2": (None, None, None)}
    assert checklists.powo(table(spark, "taxonid,a", ("1", "x")), table(spark, "taxonid,b", ("1", "y"))).first().nomenclatural_code == "ICZN"
    worms = checklists.worms(table(spark, "taxonID,a", ("1", "x")), table(spark, "taxonID,b", ("2", "y")), table(spark, "taxonID,c", ("1", "z")))
    assert {r.taxonID: (r.a, r.b, r.c) for r in worms.collect()} == {"1": ("x", None, "z"), "2": (None, "y", None)}
    goat = checklists.goat(table(spark, "taxon_id,name,field,value,aggregation_source,aggregation_method,line", *[("1", "n", f"f{i}", str(i), '"s"', "m", str(i)) for i in range(3)]), ["line"]).collect()
    assert len(goat) == 1 and [(x.field, x.aggregation_source) for x in goat[0].data] == [("f0", "s"), ("f1", "s"), ("f2", "s")]
    edna = {r.line: r for r in checklists.anemone(table(spark, "source_mat_id,organismID,line", ("unidentified S", "unidentified sp.", "1"), ("unidentified S", "O2", "2")), ["line"]).collect()}
    assert (edna["2"].haplotype, edna["2"].occurrenceID, edna["1"].organismID) == (2, "O2_S_2", None)
    reduced = checklists.iucn_reduce(table(spark, "biogeographical_realms,t", ("['Australasian' 'X']", "a\tb"), ("['X']", "c")), ["Australasian"])
    assert [r.t for r in reduced.collect()] == ["ab"]
    assert checklists.add_name(table(spark, "a", ("1",)), "Aus bus", citation="c").first().scientific_name == "Aus bus"


def test_red_list(spark, tmp_path):
    en = lambda t: {"description": {"en": t}}
    df = landed(spark, tmp_path, "i.json", [{"id": 1, "taxon": {"name": "Aus", "id": 7}, "population_trend": en("down"), "red_list_category": "VU", "biogeographical_realms": [en("A"), en("B")], "systems": [en("S")], "supplementary_info": {"name": "later"}, "scopes": [1]}])
    r = checklists.iucn_assessments(df).first()
    assert (r.population_trend, r.biogeographical_realms, r.name, r.id) == ("down", ["A", "B"], "later", 7)


def test_assemblies(spark, tmp_path):
    summary = table(spark, "#assembly_accession,biosample,taxid", ("A1", "na", "5"), ("A2", "S1", "6"))
    merged = genomes.assembly_merge(summary, table(spark, "current_accession,total", ("A1", "9"), ("A3", "8")))
    assert merged.count() == 3
    clean = {r.record_id: r.dna_extract_id for r in genomes.assembly_clean(summary).collect()}
    assert clean == {"A1": None, "A2": "S1"}
    report = {"current_accession": "A1", "annotation_info": {"name": "n", "busco": {"busco_ver": "5", "complete": 0.9, "x": 1}, "stats": {"gene_counts": {"total": 7}}}, "assembly_info": {"assembly_name": "asm", "comments": "a\nb", "paired_assembly": {"accession": "P1"}, "atypical": {"is_atypical": True}}, "assembly_stats": {"total_length": "100"}, "organelle_info": [{"description": "mt", "submitter": "s"}], "type_material": {"type_label": "T"}}
    r = genomes.genome_reports(landed(spark, tmp_path, "g.json", [report]), ["mt"], ["total_length"]).first().asDict()
    assert (r["name"], r["busco_ver"], r["busco_complete"], r["total_gene_count"], r["pa_accession"], r["at_is_atypical"], r["comments"]) == ("n", "5", 0.9, 7, "P1", True, "ab")
    assert r["mt"].submitter == "s" and r["type_label"] == "T" and "total_length" not in r and "x" not in r
    rows = table(spark, ",".join(genomes.SUMMARY_TERMS), ["A1", "P", "S1", *["v"] * (len(genomes.SUMMARY_TERMS) - 3)], ["A2", "P", None, *["v"] * (len(genomes.SUMMARY_TERMS) - 3)])
    samples = table(spark, "id," + ",".join(genomes.SAMPLE_TERMS), ["S1", "2000", "", *["w"] * 7, '{"lat_lon": "1 S 2 E", "geo_loc_name": "X"}'])
    out = {r.occurrenceID: r for r in genomes.refseq_dwc(rows, samples).collect()}
    assert (out["A1"].decimalLatitude, out["A1"].locality, out["A1"].EarliestDateCollected, out["A1"].MaterialSample) == ("-1", "X", "2000", None)
    assert (out["A2"].decimalLatitude, out["A2"].ncbi_biosample_email, out["A2"].ncbi_taxid) == (None, None, "v")


XML = """<set><BioSample accession="S1" id="5"><Description><Organism taxonomy_name="Aus bus"/></Description>
<Owner><Contacts><Contact email="e" lab="l"/></Contacts></Owner>
<Attributes><Attribute attribute_name="sex">m</Attribute><Attribute attribute_name="lat lon" harmonized_name="lat_lon">1 N 2 E</Attribute><Attribute attribute_name="sex">f</Attribute></Attributes>
</BioSample><BioSample id="7"><Description><Organism taxonomy_name="Cus"/></Description><Attributes><Attribute attribute_name="tissue">t</Attribute></Attributes></BioSample></set>"""


def test_samples(spark, tmp_path):
    (tmp_path / "b.xml").write_text(XML)
    df = readers.read_xml(spark, str(tmp_path / "b.xml"), "BioSample")
    out = {r.id: r for r in genomes.biosample_dwc(df).collect()}
    assert (out["S1"].sex, out["S1"].lat_lon, out["S1"].email, out["S1"].scientificName) == ("f", "1 N 2 E", "e", "Aus bus")
    assert json.loads(out["S1"].attrs) == {"sex": "f", "lat_lon": "1 N 2 E"} and out["SAMN00000007"].MaterialSample == "t"
    flat = genomes.biosample(df.withColumn("lat_lon", F.lit("1 2")))
    assert flat.first().decimalLongitude == "2" and "Description_Organism_taxonomy_name" in flat.columns
    codes = genomes.biocollections(table(spark, "inst_id,coll,none", ("1", "c", None)), table(spark, "inst_id,inst", ("1", "i")))
    assert codes.columns == ["inst_id", "coll", "inst"]


def test_packages_and_barcodes(spark, tmp_path):
    packages = landed(spark, tmp_path, "p.json", [{"id": "1", "type": "t", "organization": {"title": "o"}, "scientific_name": None, "species_name": None, "genus": "Aus", "species": "bus", "common_name": "c", "tags": [{"n": "x"}]}])
    assert genomes.bpa(packages, "http://h/").first().bpa_url == "http://h/t/1"
    schema_full = packages.withColumn("scientific_name", F.lit(None).cast("string")).withColumn("species_name", F.lit(None).cast("string"))
    r = genomes.bpa_dwc(schema_full, ["id", "organization.title", "scientific_name", "species_name", "genus", "species", "common_name", "tags"], {"tags": "bpa_tags", "id": "occurrenceID"}, ["bpa_tags"]).first().asDict()
    assert (r["scientificName"], r["bpa_tags"], r["bpa_id"], r["organization.title"]) == ("Aus bus", '[{"n":"x"}]', "1", "o")
    records = landed(spark, tmp_path, "r.json", [{"record_id": "R1", "taxonomy": {"species": {"taxon": {"name": "Aus bus"}}}, "sequences": {"sequence": [{"sequenceID": "1", "nucleotides": "AC"}, {"sequenceID": "2", "nucleotides": "GT"}]}}])
    out = genomes.bold_dwc(records, {"record|record_id": "occurrenceID"}).collect()
    assert len(out) == 1 and out[0].scientificName == "Aus bus" and out[0].associatedSequences[0].sequenceID == "1"
    bold = {r.k: (r.species, r.bold_bin_uri) for r in genomes.bold_augment(table(spark, "k,species,bold_bin_uri", ("1", None, "B"), ("2", "s", None)), "u=").collect()}
    assert bold == {"1": ("sp. {B}", "u=B"), "2": ("s", None)}


def test_archive(spark):
    links = table(spark, "source,target,name", ("r", "r/PRJCA1/", "d"), ("r/PRJCA1/", "r/PRJCA1/CRA2/f.gz", "f"), ("r", "r/md5", "skip"), ("r/PRJCA1/", "r", "back"))
    out = genomes.gsa(links, table(spark, "url", ("r",)), skip=["skip"]).collect()
    assert [(r.project_accession, r.experiment_accession, r.file_name) for r in out] == [("PRJCA1", "CRA2", "f.gz")]


def test_genome_metadata(spark, tmp_path):
    df = landed(spark, tmp_path, "m.json", [{"organism": {"name": "aus", "display_name": "Aus", "taxonomy_id": 5}, "assembly": {"assembly_name": "a", "sequences": [1]}, "data_release": {"version": 3}, "genebuild": "g"}])
    flat = genomes.ensembl_flatten(df).first().asDict()
    assert flat == {"display_name": "Aus", "taxonomy_id": 5, "assembly_name": "a", "version": 3, "genebuild": "g", "organism_name": "aus"}
    assert genomes.ensembl_vertebrates(df).first().assembly_accession is None
    stats = table(spark, "#name,core_db,species_id", ("Aus", "db", "1"), ("Cus", "db", "2"))
    kv = lambda *rows: spark.createDataFrame(rows, "core_db string, id string, column string, value string, line int")
    rich = genomes.ensembl_enrich(stats, kv(("db", "1", "a.b", "x", 1), ("db", "1", "a.b", "y", 2)), kv(("db", "1", "n", "7", 1)), ["a.b"], ["n"])
    assert {r["#name"]: (r.a_b, r.n) for r in rich.collect()} == {"Aus": ("y", "7"), "Cus": (None, None)}
    both = genomes.ensembl_combine(table(spark, "display_name,m", ("Aus", "1"), ("Dus", "2")), stats)
    assert both.count() == 3
    assert genomes.genomeark(landed(spark, tmp_path, "a.json", [{"name": "x", "s": {"t": {"u": 1}}}, {"name": "_y", "s": {"t": {"u": 2}}}])).collect()[0].asDict() == {"name": "x", "t_u": 1}
    assert genomes.dnazoo(df).columns[:2] == ["assembly_assembly_name", "assembly_sequences"]
    assert genomes.record_list(table(spark, "a", ("x\ny",))).first().a == "xy"


def test_pages(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>Species</th><th>Size</th></tr><tr><td>Aus</td><td>1,200</td></tr></table><table><tr><th>Key</th><td>v</td></tr></table>")], "page_id int, html string")
    assert genomes.vgp(pages, {"size": "Size"}).first().size == "1200"
    assert genomes.i5k(pages, {"key": "Key"}).first().key == "v"
    assert genomes.page_tables(pages, {"species": "Species", "none": "None"}).columns == ["page_id", "row_no", "species"]
    assert html.parse("<p>a<br>b").text() == "a b"


def test_images(spark, tmp_path):
    size = lambda u, w: {"uri": u, "width": w, "height": 2}
    museum = landed(spark, tmp_path, "v.json", [{"id": "i/1", "taxonomy": {"taxonName": "Aus"}, "media": [{"type": "image", "medium": size("h/m.jpg", 1), "small": size("h/s.jpg", 1), "caption": "<em>c</em>", "creators": ["x", "y"], "licence": {"name": "CC"}}, {"type": "video", "medium": size("h/v.mp4", 1)}]}])
    rows = occurrences.museum_images(museum).collect()
    assert len(rows) == 1 and (rows[0].identifier, rows[0].format, rows[0].description, rows[0].creator, rows[0].license) == ("h/m.jpg", "JPG", "c", "x, y", "CC")
    assert occurrences.museum(table(spark, "id,taxonomy", ("1", "{'name': 'Aus', 'rank': None}")), "name string, rank string").first().name == "Aus"
    photo = landed(spark, tmp_path, "f.json", [{"info": {"id": "7", "title": {"_content": "t"}, "description": {"_content": "d"}, "dates": {"taken": "2000"}, "owner": {"username": "u"}, "license": 4, "tags": {"tag": [{"raw": "a"}, {"raw": "b"}]}}, "sizes": {"size": [{"width": 2, "height": 2, "source": "s/x.jpg", "url": "a/b/c/d"}, {"width": 9, "height": None, "source": "s/y.png", "url": "r/1/2/3"}]}}])
    r = occurrences.host_images(photo, {"4": "CC BY"}, "host").first()
    assert (r.identifier, r.format, r.references, r.license, r.tags) == ("s/y.png", "png", "r", "CC BY", ["a", "b"])


def test_reports(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "d/b.csv").write_text("y\n22222\n")
    (tmp_path / "citation.csv").write_text("z\n")
    files = readers.list_files(spark, str(tmp_path))
    top = occurrences.largest(files, 1, folders=False).first()
    assert top.path.endswith("b.csv") and top.size_text == "8.00 B"
    assert occurrences.largest(files, 50, folders=True).count() > files.count()
    union = occurrences.biocache(spark, str(tmp_path))
    assert set(union.columns) == {"x", "y"} and union.count() == 2
    df = table(spark, "a,b", ("1", None), ("2", "x"))
    assert occurrences.find_rows(df, "a", ["2"]).count() == 1
    assert occurrences.sample_input(df, 1, 3).first()["Example #"] == 1
    assert occurrences.sample_input(df, 5, 3, "fields").count() == 3
    from fieldloom.operators.mapping import Target, convert

    events = convert(df, {"a": Target("collection", "scientific_name")}, "D")
    assert occurrences.sample_output(events, 1, "unmapped").columns == ["Example #", "unmapped_b"]
    traits = table(spark, "taxon_name,trait_name,trait_value,o", ("A", "f", "k r", "1"), ("A", "f", "r k", "2"), ("B sp. x", "f", "k", "3"), ("C", "f", "unknown", "4"), ("D", "f", " ", "5"))
    out = occurrences.trait_list(traits, ["o"])
    assert {r.taxon: r.traitValue for r in out.collect()} == {"A": "k|r", "D": "k"}
    assert "itemName" in occurrences.trait_payload(out, "n").first().payload
    assert occurrences.trait_coverage(traits).first().taxa == 4
    entry = landed(spark, tmp_path, "e.json", [{"identifier": "doi", "title": "T", "abstract": "A", "keywords": ["k1", "k2"], "locations": [{"place": "P"}], "authors": [{"firstName": "F", "lastName": "L"}]}])
    from fieldloom.operators.nested import project_entries

    r = project_entries(entry).first()
    assert (r.places, r.authors, r.funders, r.license) == (["P"], ["F L"], [], "") and r.summary.endswith("- k1\n- k2")


def test_section_pages_are_spread(spark, sf_dir):
    from fieldloom.plans.queries import QUERIES

    pages = QUERIES["page_sections"](spark, sf_dir)
    assert "REPARTITION_BY_NUM" in pages._jdf.queryExecution().executedPlan().toString()


def test_customer_pages_are_spread_and_parsed_once(spark, sf_dir):
    from fieldloom.plans.queries import QUERIES

    plan = QUERIES["organism_pages"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "REPARTITION_BY_NUM" in plan  # the table's rows lie in a file, the key/value rows are native


def test_table_function_takes_rows_in_batches(spark, sf_dir):
    from fieldloom.plans.queries import QUERIES

    plan = QUERIES["lateral_sections"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPythonUDTF" in plan and "ArrowEvalPythonUDTF" not in plan and "REPARTITION_BY_NUM" in plan
