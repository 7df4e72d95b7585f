"""Registered queries: competency and federated questions."""

from pyspark.sql import functions as F

from kgspark.model import ONT, TERMS
from kgspark.operators import harvest, questions as Q, verify
from kgspark.plans.registry import ORACLES, QUERIES, query
from kgspark.plans.sqltext import capped, e, ty, v, via

O = ONT  # noqa: E741
DB = "ont:denotedBy"
DSC = ["ont:Dataset", "ont:LegacyDataset", "ont:OpenDataset"]


def label(a, b):
    return v("rdfs:label", a, b)


def cq(key, graphs, block, cols, fn, cap=999, repeats=False):
    query(key, graphs=graphs, sql=capped(f"({block})", cols, cap))(lambda c: fn(c.repeated if repeats else c.quads))


def lj(*blocks):
    return " ".join(f"LEFT JOIN {b} USING ({k})" for b, k in blocks)


cq("cq_records", "datasets", f"""SELECT * FROM {ty(DSC, 'record')} JOIN {label('record', 'record_label')} USING (record) JOIN {e('ont:hasPart', 'record', 'part')} USING (record)
   JOIN {label('part', 'file_label')} USING (part) JOIN {v('rdf:type', 'part', 'doi')} USING (part)""", "record, record_label, file_label, doi",
   lambda q: Q.records(q, TERMS.dataset_classes, link_predicate="http://www.w3.org/1999/02/22-rdf-syntax-ns#type"))
cq("cq_fdos", "assets", f"""SELECT * FROM {ty('ont:DigitalObject', 'object')} JOIN {label('object', 'label')} USING (object) JOIN {v('ont:partOf', 'object', 'parent')} USING (object)
   JOIN {v('ont:hasUrl', 'object', 'url')} USING (object)""", "object, label, parent, url", lambda q: Q.digital_objects(q, O + "DigitalObject"))
cq("cq_software", "assets datasets", f"""SELECT * FROM {ty('ont:Software', 'software')} LEFT JOIN {via(DB, 'rdfs:label', 'software', 'label')} USING (software)
   LEFT JOIN (SELECT * FROM {e('ont:hasLicense', 'software', 'lic')} LEFT JOIN {label('lic', 'license')} USING (lic)) USING (software)
   LEFT JOIN (SELECT * FROM {e('ont:hasLanguage', 'software', 'lng')} LEFT JOIN {label('lng', 'language')} USING (lng)) USING (software)
   {lj((via(DB, 'rdfs:label', 'software', 'publication', 'ont:Title'), 'software'), (via(DB, 'ont:hasUrl', 'software', 'repository', 'ont:Repository'), 'software'))}""",
   "software, label, license, language, repository, publication", lambda q: Q.software(q, O + "Software", TERMS.title, TERMS.repository))
_u = lambda n: via("ont:isSubjectOf", "ont:hasUrl", "service", n)
cq("cq_services", "assets", f"""SELECT * FROM {ty('ont:Service', 'service')} {lj((via(DB, 'rdfs:label', 'service', 'label', 'ont:WrittenName'), 'service'), (_u('service_url'), 'service'), (_u('doc_url'), 'service'), (_u('code_url'), 'service'))}""",
   "service, label, service_url, doc_url, code_url", lambda q: Q.services(q, O + "Service"))
cq("cq_organizations", "catalog", f"""SELECT * FROM {ty('ont:Organization', 'org')} JOIN {v('ont:acronym', 'org', 'acronym')} USING (org)
   {lj((label('org', 'label'), 'org'), (via('ont:locatedIn', 'rdfs:label', 'org', 'city', 'ont:City'), 'org'), (via('ont:externalId', 'ont:hasUrl', 'org', 'registry_id'), 'org'))}""",
   "org, label, acronym, city, registry_id", lambda q: Q.organizations(q))
cq("cq_people", "catalog", f"""SELECT * FROM {ty('ont:Person', 'person')} JOIN {label('person', 'label')} USING (person)
   {lj((via(DB, 'rdfs:label', 'person', 'email', 'ont:Email'), 'person'), (v('ont:externalId', 'person', 'orcid'), 'person'))}""", "person, label, email, orcid", lambda q: Q.people(q))
cq("cq_events", "process datasets catalog", f"""SELECT * FROM {ty('ont:Process', 'event')} {lj((via(DB, 'rdfs:label', 'event', 'title', 'ont:Title'), 'event'), (via(DB, 'ont:hasUrl', 'event', 'url'), 'event'),
   (via('ont:hasParticipant', 'rdfs:label', 'event', 'org_label', 'ont:Organization'), 'event'), (via('ont:hasParticipant', 'rdfs:label', 'event', 'consortium_label', 'ont:Consortium'), 'event'))}""",
   "event, title, url, org_label, consortium_label", lambda q: Q.events(q, TERMS.process), repeats=True)
cq("cq_endpoints_about", "datasets assets", f"""SELECT dataset, term_class, dataset_name, endpoint, CAST(TRY_CAST(n AS DOUBLE) AS BIGINT) AS instances FROM {ty(DSC, 'dataset')} JOIN {via(DB, 'ont:hasUrl', 'dataset', 'endpoint')} USING (dataset)
   JOIN {e('void:classPartition', 'dataset', 'cp')} USING (dataset) JOIN {v('void:class', 'cp', 'term_class')} USING (cp) JOIN {v('void:entities', 'cp', 'n')} USING (cp) LEFT JOIN {label('dataset', 'dataset_name')} USING (dataset)
   WHERE term_class IN ('ont:type/SMALL', 'ont:type/PROMO')""", "dataset, term_class, dataset_name, endpoint, instances",
   lambda q: Q.endpoints_about(q, TERMS.dataset_classes, [O + "type/SMALL", O + "type/PROMO"]), None)
cq("cq_datasets", "datasets", f"""SELECT * FROM {ty(DSC, 'dataset')} JOIN {via(DB, 'rdfs:label', 'dataset', 'title', 'ont:Title')} USING (dataset) {lj((via('ont:hasPart', 'rdfs:label', 'dataset', 'creator', 'ont:CreatorRole'), 'dataset'),
   (via('ont:hasPart', 'rdfs:label', 'dataset', 'affiliation', 'ont:InstitutionList'), 'dataset'), (via(DB, 'ont:hasUrl', 'dataset', 'link'), 'dataset'))}""", "dataset, title, creator, affiliation, link", lambda q: Q.datasets(q))
cq("cq_dataportals", "assets", f"""SELECT * FROM {ty('ont:DataPortal', 'portal')} JOIN {via(DB, 'rdfs:label', 'portal', 'name', 'ont:Title')} USING (portal) JOIN {via(DB, 'ont:hasUrl', 'portal', 'link')} USING (portal)
   JOIN {via(DB, 'ont:hasUrl', 'portal', 'repository')} USING (portal)""", "portal, name, link, repository", lambda q: Q.data_portals(q, O + "DataPortal"))
cq("cq_instruments", "assets", f"""SELECT instrument, name, contact_name, email, website FROM {ty('ont:Instrument', 'instrument')} LEFT JOIN {via(DB, 'rdfs:label', 'instrument', 'name')} USING (instrument) LEFT JOIN (
   SELECT instrument, contact_name, email, website FROM (SELECT * FROM {e('ont:participatesIn', 'instrument', 'cp')} JOIN {e('ont:hasParticipant', 'cp', 'contact')} USING (cp) JOIN {e('ont:hasRole', 'cp', 'role')} USING (cp)
     LEFT JOIN {via(DB, 'ont:hasValue', 'contact', 'contact_name', 'ont:WrittenName')} USING (contact)
     LEFT JOIN (SELECT role, n AS n1, email FROM {e(DB, 'role', 'n')} JOIN {ty('ont:Email', 'n')} USING (n) JOIN {v('ont:hasValue', 'n', 'email')} USING (n)) USING (role)) x
   LEFT JOIN (SELECT role AS role2, n AS n2, website FROM {e(DB, 'role', 'n')} JOIN {ty('ont:Website', 'n')} USING (n) JOIN {v('ont:hasUrl', 'n', 'website')} USING (n)) w ON w.role2 = x.role AND (x.n1 IS NULL OR x.n1 = w.n2)) USING (instrument)""",
   "instrument, name, contact_name, email, website", lambda q: Q.instruments(q, O + "Instrument"))
cq("cq_facilities", "assets catalog", f"""SELECT * FROM {ty('ont:Facility', 'facility')} JOIN {via(DB, 'rdfs:label', 'facility', 'acronym', 'ont:Abbreviation')} USING (facility) LEFT JOIN {via(DB, 'rdfs:label', 'facility', 'name', 'ont:WrittenName')} USING (facility)
   LEFT JOIN (SELECT facility, org_label, email, website FROM {e('ont:outputOf', 'facility', 'pr')} JOIN {e('ont:hasParticipant', 'pr', 'org')} USING (pr) JOIN {e('ont:hasRole', 'pr', 'role')} USING (pr)
     JOIN {ty('ont:Organization', 'org')} USING (org) JOIN {label('org', 'org_label')} USING (org) JOIN {ty('ont:ProviderRole', 'role')} USING (role) JOIN {e(DB, 'role', 'n')} USING (role)
     LEFT JOIN (SELECT n, email FROM {ty('ont:Email', 'n')} JOIN {v('ont:hasValue', 'n', 'email')} USING (n)) USING (n) LEFT JOIN (SELECT n, website FROM {ty('ont:Website', 'n')} JOIN {v('ont:hasUrl', 'n', 'website')} USING (n)) USING (n)) USING (facility)""",
   "facility, name, acronym, org_label, email, website", lambda q: Q.facilities(q, O + "Facility"))
cq("cq_metadata", "assets", f"SELECT * FROM {ty('ont:MetadataSpec', 'metadata')} {lj((via(DB, 'rdfs:label', 'metadata', 'name', 'ont:WrittenName'), 'metadata'), (via(DB, 'ont:hasUrl', 'metadata', 'repository'), 'metadata'))}",
   "metadata, name, repository", lambda q: Q.named_things(q, O + "MetadataSpec", ("metadata", "name"), TERMS.written_name, with_url=True, cap=None), None)
cq("cq_ontologies", "assets", f"SELECT * FROM {ty('ont:Ontology', 'ontology')} {lj((via(DB, 'ont:hasValue', 'ontology', 'name', 'ont:WrittenName'), 'ontology'), (via(DB, 'ont:hasUrl', 'ontology', 'repository', 'ont:Repository'), 'ontology'))}",
   "ontology, name, repository", lambda q: Q.named_things(q, O + "Ontology", ("ontology", "name"), TERMS.written_name, TERMS.has_value, TERMS.repository, with_url=True))
cq("cq_collaborations", "assets", f"SELECT * FROM {ty('ont:Collaboration', 'collaboration')} {lj((via(DB, 'rdfs:label', 'collaboration', 'name', 'ont:Title'), 'collaboration'))}",
   "collaboration, name", lambda q: Q.named_things(q, O + "Collaboration", ("collaboration", "name"), TERMS.title))
cq("cq_publications", "datasets", f"""SELECT * FROM {ty(['ont:Publication', 'ont:Article'], 'publication')} {lj((label('publication', 'name'), 'publication'), (via('ont:externalId', 'ont:hasUrl', 'publication', 'doi'), 'publication'),
   (via('ont:hasPart', 'rdfs:label', 'publication', 'authors', 'ont:AuthorList'), 'publication'), (via('ont:hasPart', 'rdfs:label', 'publication', 'affiliations', 'ont:InstitutionList'), 'publication'))}""",
   "publication, name, doi, authors, affiliations", lambda q: Q.publications(q))
cq("cq_task_areas", "assets", f"SELECT * FROM {ty('ont:TaskArea', 'area')} JOIN {label('area', 'label')} USING (area) JOIN {via(DB, 'rdfs:label', 'area', 'description', 'ont:Description')} USING (area)",
   "area, label, description", lambda q: Q.task_areas(q, O + "TaskArea"))
cq("cq_use_cases", "assets", f"SELECT * FROM {ty('ont:UseCase', 'use_case')} {lj((label('use_case', 'label'), 'use_case'), (via(DB, 'rdfs:label', 'use_case', 'name', 'ont:WrittenName'), 'use_case'))}",
   "use_case, label, name", lambda q: Q.named_things(q, O + "UseCase", ("use_case", "name"), TERMS.written_name, own_label=True))
cq("cq_projects", "assets", f"SELECT * FROM {ty('ont:Project', 'project')} {lj((label('project', 'label'), 'project'), (via(DB, 'rdfs:label', 'project', 'name', 'ont:WrittenName'), 'project'))}",
   "project, label, name", lambda q: Q.named_things(q, O + "Project", ("project", "name"), TERMS.written_name, own_label=True, cap=None), None)
cq("cq_endpoints", "assets datasets", f"""SELECT * FROM {ty('ont:Endpoint', 'endpoint')} JOIN {label('endpoint', 'endpoint_label')} USING (endpoint) JOIN {v('ont:hasUrl', 'endpoint', 'url')} USING (endpoint)
   LEFT JOIN (SELECT * FROM {ty(DSC, 'dataset')} JOIN {e(DB, 'dataset', 'endpoint')} USING (dataset) LEFT JOIN {label('dataset', 'dataset_label')} USING (dataset)) USING (endpoint)""",
   "dataset, endpoint, dataset_label, endpoint_label, url", lambda q: Q.endpoints(q, O + "Endpoint", TERMS.dataset_classes), None)

# --- a second source beside the first --------------------------------------------------------------
# The assets and events graphs act as the other store; links meet where both name the same text.


def fq(key, first, second, cte, cols, fn, cap=None, repeats=False):
    one, two = (", ".join(f"'g:{g}'" for g in x.split()) for x in (first, second))
    sql = f"WITH one AS (SELECT * FROM quads WHERE graph IN ({one})), two AS (SELECT * FROM quads WHERE graph IN ({two})) {capped('(' + cte + ')', cols, cap)}"
    query(key, graphs=" ".join(dict.fromkeys((first + " " + second).split())), sql=sql)(
        lambda c: fn(*[c.t.view(*x.split(), repeats=repeats) for x in (first, second)]))


def o1(p, a, b):
    return v(p, a, b, src="one")


def o2(p, a, b, cond="TRUE"):
    return v(p, a, b, cond, src="two")


PUBS = via("ont:externalId", "ont:hasUrl", "dataset", "link", src="one")
fq("fq_samples", "assets", "assets", f"""SELECT * FROM {via(DB, 'ont:hasUrl', 'dataset', 'link', src='one')} JOIN {ty('owl:NamedIndividual', 'dataset', src='one')} USING (dataset)
   JOIN (SELECT n AS sample, link FROM {o2('ont:hasUrl', 'n', 'link')}) USING (link) JOIN {ty('ont:Repository', 'sample', src='two')} USING (sample) JOIN {o2('rdf:type', 'sample', 'unit')} USING (sample)
   JOIN {o2('ont:hasUrl', 'sample', 'amount')} USING (sample)""", "amount, dataset, link, sample, unit",
   lambda a, b: Q.federated_samples(a, b, ["http://www.w3.org/2002/07/owl#NamedIndividual"], TERMS.repository, [("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", TERMS.repository)],
                                    TERMS.has_url, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", TERMS.has_url))
DL = via(DB, "ont:hasUrl", "dataset", "link", src="one")
fq("fq_creators", "datasets", "datasets process", f"""SELECT dataset, creator, affiliation, amount FROM {DL} {lj((via('ont:hasPart', 'rdfs:label', 'dataset', 'creator', 'ont:CreatorRole', src='one'), 'dataset'),
   (via('ont:hasPart', 'rdfs:label', 'dataset', 'affiliation', 'ont:InstitutionList', src='one'), 'dataset'))} JOIN (SELECT DISTINCT link, amount FROM {o2('ont:hasUrl', 'sample', 'link')} JOIN {o2('rdf:type', 'sample', 'amount')} USING (sample)) USING (link)""",
   "dataset, creator, affiliation, amount", lambda a, b: Q.federated_creators(a, b, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", TERMS.has_url), repeats=True)
fq("fq_elements", "datasets", "datasets", f"SELECT dataset, element FROM {DL} JOIN (SELECT DISTINCT link, element FROM {o2('ont:hasUrl', 'sample', 'link')} JOIN {o2('rdf:type', 'sample', 'element')} USING (sample)) USING (link)",
   "dataset, element", lambda a, b: Q.federated_elements(a, b, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", TERMS.has_url))
fq("fq_orgs", "catalog", "datasets assets", f"""SELECT org, label, acronym, city, url, ext, ext_label, country FROM (SELECT *, regexp_replace(url, '^.*/', '') AS k FROM {ty('ont:Organization', 'org', src='one')} JOIN {via('ont:externalId', 'ont:hasUrl', 'org', 'url', src='one')} USING (org)
   {lj((o1('rdfs:label', 'org', 'label'), 'org'), (o1('ont:acronym', 'org', 'acronym'), 'org'), (via('ont:locatedIn', 'rdfs:label', 'org', 'city', 'ont:City', src='one'), 'org'))}) JOIN
   (SELECT s AS ext, o AS k FROM two WHERE p = 'void:entities') USING (k) LEFT JOIN {o2('rdfs:label', 'ext', 'ext_label', "o_lang = 'en'")} USING (ext)
   LEFT JOIN (SELECT ext, country FROM {e('void:class', 'ext', 'cc', src='two')} JOIN {o2('rdfs:label', 'cc', 'country', "o_lang = 'en'")} USING (cc)) USING (ext)""",
   "org, label, acronym, city, url, ext, ext_label, country", lambda a, b: Q.federated_orgs(a, b, "http://rdfs.org/ns/void#entities", "http://rdfs.org/ns/void#class"), 100)
fq("fq_people", "catalog", "datasets", f"""SELECT person, label, url, k AS key, ext, ext_label, employer, country FROM (SELECT *, regexp_replace(regexp_replace(url, '^https?://orcid.example.org/0*', ''), '/$', '') AS k FROM {ty('ont:Person', 'person', src='one')}
   JOIN {o1('ont:externalId', 'person', 'url')} USING (person) LEFT JOIN {o1('rdfs:label', 'person', 'label')} USING (person) WHERE contains(lower(url), 'orcid.example.org'))
   JOIN (SELECT s AS ext, substr(o, 10) AS k FROM two WHERE p = 'rdfs:label' AND starts_with(o, 'customer ')) USING (k) LEFT JOIN {o2('rdfs:label', 'ext', 'ext_label', "o_lang = 'en'")} USING (ext)
   LEFT JOIN (SELECT ext, employer FROM {e('ont:hasPart', 'ext', 'ee', src='two')} JOIN {o2('rdfs:label', 'ee', 'employer', "o_lang = 'en'")} USING (ee)) USING (ext)
   LEFT JOIN (SELECT ext, country FROM {e('rdf:type', 'ext', 'cc', src='two')} JOIN {o2('rdfs:label', 'cc', 'country', "o_lang = 'en'")} USING (cc)) USING (ext)""",
   "person, label, url, key, ext, ext_label, employer, country", lambda a, b: Q.federated_people(
       a, _customer_ids(b), "urn:customer", TERMS.has_part, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "orcid.example.org", "^https?://orcid.example.org/0*"), 100)


def _customer_ids(q):
    """The other store names customers in creator labels; read them as identifiers."""
    ids = q.where((F.col("p") == "http://www.w3.org/2000/01/rdf-schema#label") & F.col("o").startswith("customer "))
    return q.unionByName(ids.withColumn("p", F.lit("urn:customer")).withColumn("o", F.substring("o", 10, 2 ** 31 - 1)))


# --- discovery -----------------------------------------------------------------------------------------

@query("known_repos", graphs="assets", preds="ont:denotedBy ont:hasUrl", sql="""
    WITH u AS (SELECT a.s, string_split(regexp_replace(trim(b.o), '^(https?://[^/]*/|git@[^:]*:)', ''), '/') AS seg FROM quads a JOIN quads b ON a.o = b.s AND b.p = 'ont:hasUrl'
      WHERE a.p = 'ont:denotedBy' AND regexp_matches(lower(b.o), '^\\s*(https?://(www\\.)?|git@)github\\.com[:/]'))
    SELECT repo, min(s) AS kg_iri FROM (SELECT s, seg[1] || '/' || regexp_replace(regexp_extract(seg[2], '^[^?#]*'), '\\.git$', '') AS repo FROM u WHERE len(seg) >= 2 AND seg[2] <> '') GROUP BY repo""")
def _(c):
    return harvest.known_repos(c.quads, TERMS.denoted_by, TERMS.has_url)


@query("archive_urls", graphs="assets", preds="a ont:denotedBy ont:hasUrl", sql=f"""
    SELECT record, min(dataset) AS dataset FROM (SELECT dataset, regexp_extract(url, 'zenodo\\.org/records/(\\d+)', 1) AS record FROM {ty(['ont:Software', 'ont:Service', 'ont:DataPortal', 'ont:Ontology'], 'dataset')}
    JOIN {via('ont:denotedBy', 'ont:hasUrl', 'dataset', 'url')} USING (dataset) WHERE contains(lower(url), 'zenodo')) WHERE record <> '' GROUP BY record""")
def _(c):
    return harvest.archive_records(c.quads, [O + k for k in ("Software", "Service", "DataPortal", "Ontology")], TERMS.denoted_by, TERMS.has_url)


@query("pipe_producer", graphs="process datasets", preds="ont:outputOf ont:hasInput label", sql=f"""
    SELECT step, count(DISTINCT artefact) AS artefacts, count(DISTINCT label) AS labels FROM {e('ont:hasInput', 'artefact', 'step')} JOIN {label('step', 'label')} USING (step) GROUP BY step""")
def _(c):
    rows = Q.producers(c.quads, TERMS.has_input)
    per = rows.groupBy("step", "label").agg(F.count_distinct("artefact").alias("a"))
    return per.groupBy("step").agg(F.max("a").alias("artefacts"), F.count(F.lit(1)).alias("labels"))


@query("cq_report")
def _(c):
    names = [k for k in QUERIES if k.startswith("cq_") and k != "cq_report"]
    return verify.non_empty_report({k: QUERIES[k](c.spark, c.t.dir) for k in names})


ORACLES["cq_report"] = " UNION ALL ".join(f"SELECT '{k}' AS question, EXISTS (SELECT 1 FROM ({ORACLES[k]})) AS non_empty" for k in QUERIES if k.startswith("cq_") and k != "cq_report")
