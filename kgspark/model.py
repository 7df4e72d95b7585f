"""Quad schema, term kinds and the vocabulary every operator takes as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
VOID = "http://rdfs.org/ns/void#"
TIME = "http://www.w3.org/2006/time#"
OBO = "http://purl.obolibrary.org/obo/"
BASE = "https://kg.example.org/"
ONT = BASE + "ont/"

PREFIXES = {
    "rdf": RDF, "rdfs": RDFS, "owl": OWL, "xsd": XSD, "void": VOID,
    "time": TIME, "obo": OBO, "ont": ONT, "b": BASE, "g": BASE + "g/", "stat": BASE + "stat/",
}

TYPE = RDF + "type"
LABEL = RDFS + "label"
COMMENT = RDFS + "comment"
SEE_ALSO = RDFS + "seeAlso"
SUBCLASS = RDFS + "subClassOf"
SUBPROP = RDFS + "subPropertyOf"
DOMAIN = RDFS + "domain"
RANGE = RDFS + "range"
SAME_AS = OWL + "sameAs"

IRI, BNODE, LITERAL = "iri", "bnode", "literal"
DEFAULT_GRAPH = "urn:default"

QUAD_COLS = ["graph", "s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang"]
TRIPLE_COLS = QUAD_COLS[1:]
QUAD = T.StructType([
    T.StructField(c, T.StringType(), c == "o_datatype") for c in QUAD_COLS
])


def expand(token: str) -> str:
    """``ont:Person`` -> full IRI; ``a`` -> rdf:type; full IRIs pass through."""
    if token == "a":
        return TYPE
    if token == "label":
        return LABEL
    prefix, _, local = token.partition(":")
    if prefix in PREFIXES and not local.startswith("//"):
        return PREFIXES[prefix] + local
    return token


@dataclass(frozen=True)
class Terms:
    """The vocabulary of one ontology version. Every IRI is configuration."""

    person: str = ONT + "Person"
    organization: str = ONT + "Organization"
    city: str = ONT + "City"
    event: str = ONT + "Event"
    title: str = ONT + "Title"
    written_name: str = ONT + "WrittenName"
    email: str = ONT + "Email"
    website: str = ONT + "Website"
    repository: str = ONT + "Repository"
    description: str = ONT + "Description"
    acronym_node: str = ONT + "Abbreviation"
    identifier: str = ONT + "Identifier"
    file: str = ONT + "File"
    data_collection: str = ONT + "Dataset"
    process: str = ONT + "Process"
    region: str = ONT + "Region1D"
    instant: str = ONT + "Instant"
    creator_role: str = ONT + "CreatorRole"
    author_list: str = ONT + "AuthorList"
    institution_list: str = ONT + "InstitutionList"
    consortium: str = ONT + "Consortium"
    provider_role: str = ONT + "ProviderRole"
    endpoint: str = ONT + "Endpoint"
    denoted_by: str = ONT + "denotedBy"
    has_value: str = ONT + "hasValue"
    has_url: str = ONT + "hasUrl"
    has_part: str = ONT + "hasPart"
    part_of: str = ONT + "partOf"
    output_of: str = ONT + "outputOf"
    has_input: str = ONT + "hasInput"
    participant: str = ONT + "hasParticipant"
    participates_in: str = ONT + "participatesIn"
    has_role: str = ONT + "hasRole"
    located_in: str = ONT + "locatedIn"
    external_id: str = ONT + "externalId"
    acronym: str = ONT + "acronym"
    literal_title: str = ONT + "literalTitle"
    occupies: str = ONT + "occupies"
    first_instant: str = ONT + "firstInstant"
    last_instant: str = ONT + "lastInstant"
    timestamp: str = ONT + "timestamp"
    license: str = ONT + "hasLicense"
    language: str = ONT + "hasLanguage"
    subject_of: str = ONT + "isSubjectOf"
    about: str = ONT + "isAbout"
    role_of: str = ONT + "roleOf"
    realized_in: str = ONT + "realizedIn"
    precedes: str = ONT + "precedes"
    dataset_classes: tuple = (ONT + "Dataset", ONT + "LegacyDataset", ONT + "OpenDataset")
    publication_classes: tuple = (ONT + "Publication", ONT + "Article")
    replacements: dict = field(default_factory=lambda: {
        ONT + "LegacyDataset": ONT + "Dataset",
        ONT + "Article": ONT + "Publication",
    }, hash=False)

    def at_version(self, version: str) -> "Terms":
        """3.0.1 and older keep deprecated classes; newer versions use the replacements."""
        if tuple(int(x) for x in version.split(".")) <= (3, 0, 1):
            return self
        swap = self.replacements
        changed = {k: swap[v] for k, v in self.__dict__.items() if isinstance(v, str) and v in swap}
        return replace(self, **changed)


TERMS = Terms()


def _fields(*cols: str) -> T.StructType:
    """Metric tables: ts_utc and graph first; names with a trailing # are counts."""
    out = [T.StructField("ts_utc", T.TimestampType(), False), T.StructField("graph", T.StringType(), False)]
    for c in cols:
        if c.endswith("#"):
            out.append(T.StructField(c[:-1], T.LongType(), False))
        else:
            out.append(T.StructField(c, T.StringType(), True))
    return T.StructType(out)


# table -> (schema, key of its latest view; None = pass-through view)
METRIC_TABLES = {
    "graph_stats": (_fields("triples#"), ["graph"]),
    "subject_counts": (_fields("subjects#"), ["graph"]),
    "class_counts": (_fields("class_iri", "class_label", "instances#"), ["graph", "class_iri"]),
    "property_counts": (_fields("property_iri", "usage_count#"), ["graph", "property_iri"]),
    "class_property_flow": (
        _fields("source_iri", "source_label", "target_iri", "target_label", "value#"),
        ["graph", "source_iri", "target_iri"]),
    "entity_type_counts": (_fields("concept_iri", "concept_label", "count#"), ["graph", "concept_iri"]),
    "dataset_type_counts": (
        _fields("dataset_type_iri", "dataset_type_label", "count#"), ["graph", "dataset_type_iri"]),
    "content_counts": (_fields("datasets#", "publications#", "events#"), ["graph"]),
    "datasets": (
        _fields("dataset_iri", "title", "creator", "creator_affiliation", "link"), ["graph", "dataset_iri"]),
    "org_city_counts": (_fields("city_iri", "city_label", "org_count#"), ["graph", "city_iri"]),
    "top_org_by_people": (_fields("org_iri", "org_label", "people_count#"), ["graph", "org_iri"]),
    "top_concepts": (_fields("concept_iri", "concept_label", "count#", "rank#"), None),
}
