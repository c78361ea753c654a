"""Schemas of nodes, edges and source records, as DDL. Null means: not known; writers put '' or [] where a source has no value."""

from __future__ import annotations

from pyspark.sql import types as T

#: label -> (key column, columns)
NODES: dict[str, tuple[str, str]] = {
    "Protein": (
        "accession",
        "accession STRING, name STRING, gene_name STRING, organism STRING, taxon_id INT, sequence STRING, length INT, mol_weight INT, is_reviewed BOOLEAN, "
        "function_text STRING, ec_numbers ARRAY<STRING>, string_id STRING, pdb_ids ARRAY<STRING>, pdb_entry_urls ARRAY<STRING>, pdb_cif_urls ARRAY<STRING>, "
        "pdb_pdb_urls ARRAY<STRING>, alphafold_entry_ids ARRAY<STRING>, alphafold_cif_urls ARRAY<STRING>, alphafold_pdb_urls ARRAY<STRING>, alphafold_cif_url STRING, alphafold_pdb_url STRING",
    ),
    "ProteinFeature": ("accession", "accession STRING, name STRING, source_database STRING, type STRING, integrated STRING"),
    "GOTerm": ("go_id", "go_id STRING, name STRING, aspect STRING, definition STRING, is_obsolete BOOLEAN"),
    "PubMedArticle": (
        "pmid",
        "pmid STRING, title STRING, abstract STRING, journal STRING, journal_abbrev STRING, year STRING, volume STRING, issue STRING, pages STRING, doi STRING, pmc STRING, "
        "pubmed_url STRING, full_text STRING, authors ARRAY<STRING>, mesh_terms ARRAY<STRING>, publication_types ARRAY<STRING>",
    ),
    "Pathway": ("kegg_id", "kegg_id STRING, name STRING, description STRING, pathway_class STRING, genes ARRAY<STRING>, compounds ARRAY<STRING>"),
}

#: type -> (source label, target label, key columns beyond src and dst, columns beyond src and dst)
EDGES: dict[str, tuple[str, str, tuple[str, ...], str]] = {
    "INTERACTS_WITH": (
        "Protein", "Protein", ("string_pair",),
        "string_pair STRING, score DOUBLE, confidence DOUBLE, escore DOUBLE, dscore DOUBLE, tscore DOUBLE, nscore DOUBLE, ascore DOUBLE, fscore DOUBLE, dominant_source STRING",
    ),
    "HAS_GO_ANNOTATION": ("Protein", "GOTerm", ("go_id", "qualifier"), "go_id STRING, qualifier STRING, evidence_code STRING, eco_code STRING, reference STRING, assigned_by STRING, is_experimental BOOLEAN"),
    "HAS_FEATURE": ("Protein", "ProteinFeature", ("start", "end"), "start INT, end INT, score DOUBLE, model STRING"),
    "CITED_IN": ("Protein", "PubMedArticle", (), ""),
    "EVIDENCED_BY": ("ProteinFeature", "PubMedArticle", (), ""),
    "IN_PATHWAY": ("Protein", "Pathway", (), ""),
    "ENZYMATIC_REACTION": ("Protein", "Protein", ("ec_number", "pathway_id"), "ec_number STRING, pathway_id STRING"),
}

#: source -> DDL of a record as it is delivered
RECORDS: dict[str, str] = {
    "uniprot": (
        "primaryAccession STRING, secondaryAccessions ARRAY<STRING>, uniProtkbId STRING, entryType STRING, annotationScore DOUBLE, "
        "organism STRUCT<scientificName: STRING, commonName: STRING, taxonId: INT, lineage: ARRAY<STRING>>, sequence STRUCT<value: STRING, length: INT, molWeight: INT, crc64: STRING, md5: STRING>, "
        "proteinDescription STRUCT<recommendedName: STRUCT<fullName: STRUCT<value: STRING>, shortNames: ARRAY<STRUCT<value: STRING>>, ecNumbers: ARRAY<STRUCT<value: STRING>>>>, "
        "genes ARRAY<STRUCT<geneName: STRUCT<value: STRING>>>, comments ARRAY<STRUCT<commentType: STRING, texts: ARRAY<STRUCT<value: STRING>>>>, "
        "features ARRAY<STRUCT<type: STRING, location: VARIANT, description: STRING, featureId: STRING>>, "
        "uniProtKBCrossReferences ARRAY<STRUCT<database: STRING, id: STRING, properties: ARRAY<STRUCT<key: STRING, value: STRING>>>>, dbReferences VARIANT, "
        "keywords ARRAY<STRUCT<id: STRING, name: STRING, category: STRING>>"
    ),
    "pdb": (
        "rcsb_id STRING, rcsb_entry_info STRUCT<experimental_method: STRING, resolution_combined: ARRAY<DOUBLE>, polymer_entity_count: INT, nonpolymer_entity_count: INT, "
        "deposited_atom_count: INT, polymer_composition: STRING, structure_determination_methodology: STRING>, struct STRUCT<title: STRING>, rcsb_primary_citation VARIANT, audit_author ARRAY<STRUCT<name: STRING, pdbx_ordinal: INT>>"
    ),
    "pdb_polymer": (
        "rcsb_id STRING, entity_poly STRUCT<pdbx_seq_one_letter_code: STRING, pdbx_seq_one_letter_code_can: STRING, type: STRING, pdbx_strand_id: STRING, rcsb_sample_sequence_length: INT>, "
        "rcsb_polymer_entity_container_identifiers STRUCT<entry_id: STRING, entity_id: STRING, auth_asym_ids: ARRAY<STRING>, asym_ids: ARRAY<STRING>, uniprot_ids: ARRAY<STRING>>, "
        "rcsb_entity_source_organism ARRAY<STRUCT<ncbi_taxonomy_id: INT, ncbi_scientific_name: STRING>>"
    ),
    "pdb_ligand": "rcsb_id STRING, pdbx_entity_nonpoly STRUCT<comp_id: STRING, name: STRING>",
    "alphafold": (
        "entryId STRING, gene STRING, uniprotAccession STRING, uniprotId STRING, uniprotDescription STRING, taxId INT, organismScientificName STRING, uniprotStart INT, uniprotEnd INT, "
        "uniprotSequence STRING, modelCreatedDate STRING, latestVersion INT, allVersions ARRAY<INT>, isReviewed BOOLEAN, isReferenceProteome BOOLEAN, cifUrl STRING, bcifUrl STRING, pdbUrl STRING"
    ),
    "interpro": "accession STRING, payload STRING",
    "string": "stringId_A STRING, stringId_B STRING, preferredName_A STRING, preferredName_B STRING, ncbiTaxonId INT, score DOUBLE, nscore DOUBLE, fscore DOUBLE, pscore DOUBLE, ascore DOUBLE, escore DOUBLE, dscore DOUBLE, tscore DOUBLE",
    "string_mapping": "queryIndex INT, stringId STRING, ncbiTaxonId INT, taxonName STRING, preferredName STRING, annotation STRING",
    "string_enrichment": "category STRING, term STRING, number_of_genes INT, number_of_genes_in_background INT, ncbiTaxonId INT, inputGenes ARRAY<STRING>, preferredNames ARRAY<STRING>, p_value DOUBLE, fdr DOUBLE, description STRING",
    "go": (
        "id STRING, geneProductId STRING, geneProductDb STRING, qualifier STRING, goId STRING, goName STRING, goAspect STRING, evidenceCode STRING, goEvidence STRING, reference STRING, withFrom VARIANT, "
        "taxonId INT, taxonName STRING, assignedBy STRING, symbol STRING, date STRING, extensions VARIANT"
    ),
    "go_term": "id STRING, name STRING, definition VARIANT, aspect STRING, isObsolete BOOLEAN, synonyms VARIANT, comment STRING, children ARRAY<STRUCT<id: STRING, relation: STRING>>",
    "kegg": "entry_id STRING, raw STRING",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl) if ddl else T.StructType([])


def node_schema(label: str) -> T.StructType:
    return struct(NODES[label][1])


def edge_schema(kind: str) -> T.StructType:
    return T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()), *struct(EDGES[kind][3]).fields])
