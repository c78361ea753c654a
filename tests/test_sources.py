import json

import pytest
from pyspark.sql import functions as F

from lattica.functions import flatfile, records, text, xml
from lattica.sources import readers
from lattica.sources.transport import Limits, Requester, Response, ServiceError, backoff, limits


class Script:
    """Answers in turn; the clock moves by sleeping only."""

    def __init__(self, *answers):
        self.answers, self.slept, self.now, self.starts = list(answers), [], 0.0, []

    def __call__(self, method, address, parameters):
        self.starts.append(self.now)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def requester(script, **kw):
    return Requester(script, Limits(**kw), lambda: script.now, script.sleep)


def test_retries():
    s = Script(Response(503), ConnectionError("lost"), Response(200, b"ok"))
    assert requester(s, delay=0).get("u").body == b"ok" and s.slept == [1.0, 2.0]
    s = Script(Response(429, headers={"Retry-After": "7"}), Response(429), Response(200))
    assert requester(s, delay=0).get("u").status == 200 and s.slept == [7.0, 20.0]
    with pytest.raises(ServiceError) as e:
        requester(Script(Response(404, b"x" * 900)), delay=0).get("u")
    assert e.value.status == 404 and "x" * 500 in str(e.value) and "x" * 501 not in str(e.value)
    with pytest.raises(ServiceError, match="429"):
        requester(Script(*[Response(429)] * 3), delay=0).get("u")
    assert [backoff(500, 2), backoff(429, 1), backoff(400, 0)] == [4.0, 20.0, None]


def test_spacing():
    s = Script(Response(200), Response(200), Response(200))
    r = requester(s, delay=0.5)
    for _ in range(3):
        r.get("u")
    assert s.starts == [0.0, 0.5, 1.0]
    assert limits("pubmed", "key").delay < limits("pubmed").delay


def echo(method, address, parameters):
    if "bad" in address:
        return Response(404, b"none")
    return Response(200, address.encode())


def test_request_source(spark):
    spark.dataSource.register(readers.request_source(echo))
    got = spark.read.format("requests").options(addresses=json.dumps(["a", "bad", "c"]), at_once="2", delay="0").load().collect()
    assert sorted((r["address"], r["status"], r["body"]) for r in got) == [("a", 200, "a"), ("bad", 404, None), ("c", 200, "c")]


def test_flat_file(spark):
    raw = "dropped\n ENTRY\nENTRY       g1   CDS\nNAME        first\n            second line\nPATHWAY     p1  one two\n            alone\nORTHOLOGY   K1  kinase [EC:1.2.3.4 5.6.7.8] EC:1.2.3.4\nDBLINKS     UniProt: P1 P2\n            Other: x\nPATHWAY     p2  three\nORGANISM    hsa  Homo\nSTRUCTURE   PDB: 1ABC 2DEF\n            Other: 9\n///\nNAME        after"
    raw = raw.replace("dropped\n", " dropped\n").replace(" ENTRY\nENTRY", "ENTRY")
    df = spark.createDataFrame([(1, raw), (2, "NAME  no end line"), (3, ""), (4, None)], "id int, raw string")
    r = {x["id"]: x for x in df.select("id", flatfile.gene_entry(F.col("raw")).alias("g"), flatfile.section(flatfile.sections(F.col("raw")), "NAME").alias("n")).collect()}
    g = r[1]["g"]
    assert (g["entry_id"], g["name"], g["ko"], g["organism_code"], g["uniprot"]) == ("g1", "first", "K1", "hsa", "P1")
    assert [tuple(p) for p in g["pathways"]] == [("p1", "one two"), ("p2", "three")] and g["ec_numbers"] == ["1.2.3.4"] and g["pdb_ids"] == ["1ABC", "2DEF"]
    assert r[1]["n"] == ["first", "second line"] and r[2]["n"] == ["no end line"] and r[3]["n"] == [] and r[4]["n"] is None
    e = spark.createDataFrame([("ENTRY       EC 2.7.11.1  Enzyme\nSUBSTRATE   ATP [CPD:C1]\nGENES       HSA: 1(A) 2\n            MMU: 3(B)\n///",)], "raw string").select(flatfile.enzyme_entry(F.col("raw")).alias("e")).first()["e"]
    assert (e["ec"], e["substrates"], e["genes"]) == ("2.7.11.1", ["ATP"], {"hsa": ["1", "2"], "mmu": ["3"]})


ARTICLE = """<!DOCTYPE x SYSTEM "http://nowhere/x.dtd"><PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><Title>Long</Title><ISOAbbreviation>Sh</ISOAbbreviation>
<JournalIssue><Volume>1</Volume><PubDate><MedlineDate>2001 Spring</MedlineDate></PubDate></JournalIssue></Journal><ArticleTitle>A <i>b</i> c</ArticleTitle><Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract>
<AuthorList><Author><LastName>L</LastName><ForeName>F</ForeName></Author></AuthorList><PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">own</ArticleId></ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">cited</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation/></PubmedArticle></PubmedArticleSet>"""


def test_article_xml(spark):
    got = spark.createDataFrame([(ARTICLE,), ("<broken",), (None,), ("",)], "x string").select(F.explode_outer(xml.parse_articles("x")).alias("a")).where("a is not null").collect()
    assert len(got) == 1
    a = got[0]["a"]
    assert (a["pmid"], a["title"], a["abstract"], a["year"], a["doi"], a["journal_abbrev"]) == ("7", "A b c", "AIM: x y", "2001 Spring", "own", "Sh")
    old = xml.articles_of(ARTICLE, compat=True)[0]
    assert (old["title"], old["doi"]) == ("A ", "cited")
    full = '<a xmlns="urn:x"><p>one  <b>two</b></p><p> </p><s><p>out<p>in</p></p></s></a>'
    assert spark.createDataFrame([(full,), (None,)], "x string").select(xml.paragraphs("x")).collect()[0][0] == "one two\n\noutin\n\nin"


def test_files(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("up:P1\thsa:1\nbad line\nup:P1\thsa:2\nup:P2\thsa:3\n")
    pairs = readers.read(spark, "kegg", str(tmp_path / "m.tsv"), format="tsv")
    assert {(r[0], r[1]) for r in readers.conversions(pairs).collect()} == {("P1", "hsa:1"), ("P2", "hsa:3")}
    assert {(r[0], r[1]) for r in readers.conversions(pairs, batch=True).collect()} == {("P1", "hsa:2"), ("P2", "hsa:3")}
    assert [r["id"] for r in readers.find(pairs, "HSA:3").collect()] == ["up:P2"]
    (tmp_path / "s.fasta").write_text(">one x\nAC\nGT\n>two\nA\n")
    assert {tuple(r) for r in readers.read_fasta(spark, str(tmp_path / "s.fasta")).collect()} == {("one x", "ACGT"), ("two", "A")}
    (tmp_path / "1abc.pdb").write_text("ATOM\nEND")
    assert [tuple(r) for r in readers.read_structures(spark, str(tmp_path / "1abc.pdb")).orderBy("line_no").collect()] == [("1ABC", 0, "ATOM"), ("1ABC", 1, "END")]
    (tmp_path / "page.json").write_text(json.dumps({"results": [{"stringId": "x", "ncbiTaxonId": 1}], "next": None}))
    from lattica.schemas import RECORDS

    assert readers.read_pages(spark, str(tmp_path / "page.json"), RECORDS["string_mapping"]).select("stringId", "ncbiTaxonId").collect()[0][0] == "x"
    (tmp_path / "g.txt").write_text("ENTRY x\n///")
    assert readers.read(spark, "kegg", str(tmp_path / "g.txt"), format="flat").first()["entry_id"] == "g"


def test_search(spark):
    df = spark.createDataFrame([("P1", "G1", (9606,), True), ("P2", "G1", (10090,), False)], "primaryAccession string, gene_name string, organism struct<taxonId: int>, is_reviewed boolean")
    assert [r[0] for r in df.where(readers.where("gene:G1 AND organism_id:9606")).collect()] == ["P1"]
    assert [r[0] for r in df.where(readers.where("gene:G1", reviewed_only=True)).collect()] == ["P1"]
    with pytest.raises(ValueError):
        readers.where("color:red")
    terms = spark.createDataFrame([("2", "protein kinase activity"), ("1", "kinase"), ("3", "other")], "id string, name string")
    assert [r["id"] for r in readers.keyword_hits(terms, "protein kinase").collect()] == ["2", "1"]


def test_accessors(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    s = F.lit
    assert [get(records.is_reviewed(s(x))) for x in ("UniProtKB reviewed (Swiss-Prot)", "UniProtKB unreviewed (TrEMBL)", None)] == [True, False, False]
    assert get(records.is_reviewed(s("UniProtKB unreviewed (TrEMBL)"), strict_compat=True)) is True
    assert [get(records.fragment_number(s(x))) for x in ("AF-P1-F3", "AF-P1", "F2-x", "AF-P1-F3x")] == [3, 1, 2, 1]
    assert get(records.sequence_length(s(None).cast("int"), s(5), s("AC"))) == 2 and get(records.sequence_length(s(2), s(5), s(None))) == 4
    assert get(records.prediction_url(s("AF-P1-F1"), s(4), "pae")).endswith("AF-P1-F1-predicted_aligned_error_v4.json")
    assert get(records.error_matrix(s('[{"predicted_aligned_error": [[0.5, 1], [1, 0]]}]'))) == [[0.5, 1.0], [1.0, 0.0]]
    assert get(records.is_square(F.expr("array(array(1), array(2))"))) is False
    assert get(records.properties_map(F.expr("array(named_struct('key','a','value','1'), named_struct('key','a','value','2'))"))) == {"a": "2"}
    assert get(text.safe_name(s(" a/b  c_"))) == "a_b_c" and get(F.array_join(text.pmids_in(F.expr("named_struct('PMID', 'PMID:2 pmid 1')")), ",")) == "1,2"
    assert get(records.definition_text(F.parse_json(s('"plain"')))) == "plain" and get(records.definition_text(F.parse_json(s('{"text": "t"}')))) == "t"
    tie = {c: s(0.5) for c, _ in records.CHANNELS}
    assert get(records.dominant_source(tie)) == "experimental" and get(records.dominant_source(tie | {"pscore": s(0.9)})) == "cooccurrence"
    m = one.select(text.messages(text.network_prompt(F.array(s("A"), s("B")), s(None).cast("array<string>"), s(None).cast("array<string>"), s(None).cast("array<string>"))).alias("m")).first()["m"]
    assert m is None or m[0]["role"] == "system"


def test_services_say_who_asks(tmp_path):
    from lattica.sources.transport import Limits, Requester, Response, Service, download, text, version

    pubmed, string = Service("pubmed", email="a@b", api_key="k"), Service("string", address="http://here/")
    assert pubmed.parameters(db="pubmed", retmax=5, term=None) == {"tool": "lattica", "email": "a@b", "api_key": "k", "db": "pubmed", "retmax": "5"}
    assert pubmed.limits.delay == 0.11 and Service("pubmed").limits.delay == 0.35 and Service("kegg", own_limits=Limits(2.0)).limits.delay == 2.0
    assert string.url("/json/version") == "http://here/json/version" and string.joined(["a", "b"]) == "a\r\nb" and Service("kegg").joined("ab") == "a+b" and Service("go").joined("ab") == "a,b"
    answers = {"http://here/json/version": b'[{"string_version": "12"}]', "http://here/x.cif": b"\xff\x00data"}
    seen = []

    def transport(method, address, parameters):
        seen.append((address, dict(parameters)))
        return Response(200, answers[address]) if address in answers else Response(404, b"no")

    r = Requester(transport, Limits(0))
    assert version(r, string) == {"string_version": "12"} and seen[0][1] == {"caller_identity": "lattica"}
    assert text(r, "http://here/x.cif").endswith("data")
    assert download(r, "http://here/x.cif", str(tmp_path / "a/x.cif")) and (tmp_path / "a/x.cif").read_bytes() == b"\xff\x00data"
    assert not download(r, "http://here/none", str(tmp_path / "b/y.cif")) and not (tmp_path / "b").exists()


def test_search_by_fields_and_words(spark):
    from lattica.sources.readers import search

    rows = [("P1", "TP53", 9606, True, "Cellular tumor antigen"), ("P2", "TP53", 10090, True, "Tumor antigen"), ("P3", "X", 9606, False, "other")]
    e = spark.createDataFrame([(a, g, (t,), r, w) for a, g, t, r, w in rows], "primaryAccession string, gene_name string, organism struct<taxonId: int>, is_reviewed boolean, search_text string")
    names = lambda df: sorted(r["primaryAccession"] for r in df.collect())
    assert names(search(e, "gene:TP53 AND organism_id:9606")) == ["P1"] and names(search(e, "(tumor) AND gene:TP53", ["primaryAccession"])) == ["P1", "P2"]
    assert names(search(e, "TUMOR cellular")) == ["P1"] and names(search(e, "", reviewed_only=True)) == ["P1", "P2"] and search(e, "other", ["gene_name"]).columns == ["gene_name"]


def test_terms_polymers_and_ligands(spark):
    terms = ['{"id": "GO:1", "name": "n", "definition": {"text": "d", "xrefs": ["r"]}, "synonyms": [{"name": "s", "type": "exact"}, "x"], "children": [{"id": "GO:2"}], "isObsolete": true}', '{"definition": "plain"}', "{}"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "i int, t string").orderBy("i").select(records.go_term(F.try_parse_json("t"))).collect()]
    assert (got[0]["definition"], got[0]["definition_xrefs"], got[0]["is_obsolete"], got[0]["children"]) == ("d", ["r"], True, ["GO:2"]) and [tuple(s) for s in got[0]["synonyms"]] == [("s", "exact")]
    assert (got[1]["definition"], got[1]["id"]) == ("plain", "") and got[2]["definition"] is None and got[2]["synonyms"] == [] and got[2]["is_obsolete"] is False
    e = spark.createDataFrame([('{"pdbx_entity_nonpoly": {"comp_id": "HEM"}, "chem_comp": {"name": "heme"}}',), ("{}",)], "t string").select(records.ligand(F.try_parse_json("t")).alias("l")).collect()
    assert [tuple(r["l"]) for r in e] == [("HEM", "heme"), (None, None)]
    p = spark.createDataFrame([((["P1"],), ("MK",)), (None, None)], "rcsb_polymer_entity_container_identifiers struct<uniprot_ids: array<string>>, entity_poly struct<pdbx_seq_one_letter_code_can: string>")
    assert [tuple(r[0]) for r in p.select(records.polymer(F.struct(*p.columns))).collect()] == [(["P1"], "MK"), ([], None)]


def test_fasta_headers_and_conversions_of_several_files(spark, tmp_path):
    from lattica.sources.readers import conversions, read_fasta

    (tmp_path / "a.fasta").write_text(">sp|P1|X 5'->3' exonuclease\nMKV\nAA\n>P2\nGG\n")
    got = {r["header"]: r["sequence"] for r in read_fasta(spark, str(tmp_path / "a.fasta")).collect()}
    assert got == {"sp|P1|X 5'->3' exonuclease": "MKVAA", "P2": "GG"}
    pairs = spark.createDataFrame([("b", 0, "up:P", "x:2"), ("a", 5, "up:P", "x:1"), ("a", 7, "up:P", "x:3")], "file string, line int, id string, value string")
    assert conversions(pairs).first()["gene_id"] == "x:1" and conversions(pairs, batch=True).first()["gene_id"] == "x:2"


def test_lines_of_a_file_in_blocks(spark, tmp_path):
    (tmp_path / "big.tsv").write_text("".join(f"up:P{k % 7}\thsa:{k}\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pairs = readers.read_tsv(spark, str(tmp_path / "big.tsv"))
        assert pairs.rdd.getNumPartitions() > 4
        assert {r["accession"]: r["gene_id"] for r in readers.conversions(pairs).collect()} == {f"P{k}": f"hsa:{k}" for k in range(7)}
        assert {r["accession"]: r["gene_id"] for r in readers.conversions(pairs, batch=True).collect()} == {f"P{k % 7}": f"hsa:{k}" for k in range(19_993, 20_000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
