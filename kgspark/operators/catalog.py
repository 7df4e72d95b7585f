"""Flat catalogue records to twelve linked entity tables, all keyed by minted IRIs.

First-wins and last-wins maps of a record-at-a-time normaliser are written as min_by / max_by
over the record order, which combine before the shuffle; a value shared by very many records
(one licence, one publisher) is one partial row per task.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from kgspark.functions.scalars import date_mdy, sanitize, split_list, uuid5
from kgspark.model import BASE, TERMS, Terms

NAMESPACE = "12345678-1234-5678-1234-567812345678"


def zip_lists(df: DataFrame, columns: dict[str, str], sep: str = ";", pos: str = "pos", keep_blanks: bool = False) -> DataFrame:
    """Parallel delimited cells paired by position, padded with '' to the longest."""
    lists = F.arrays_zip(*[split_list(c, sep, keep_blanks).alias(n) for n, c in columns.items()])
    out = df.select("*", F.posexplode(lists).alias(pos, "__z"))
    return out.select(*df.columns, pos, *[F.coalesce(F.col("__z")[n], F.lit("")).alias(n) for n in columns])


class Catalog:
    """``records``: ord (record order) plus the flat catalogue columns; missing ones read as ''."""

    COLUMNS = ["id", "title", "description", "metadata_created", "license_id", "license_title", "organization_id",
               "organization_title", "organization_description", "resource_urls", "contact_name", "contact_email",
               "contributor_name", "contributor_email", "publisher_name", "publisher_email", "publisher_uri"]

    def __init__(self, records: DataFrame, base: str = BASE, namespace: str = NAMESPACE, terms: Terms = TERMS,
                 keep_blanks: bool = False):
        self.base, self.ns, self.terms, self.keep_blanks = base, namespace, terms, keep_blanks
        cols = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in records.columns else F.lit("").alias(c) for c in self.COLUMNS]
        r = records.select("ord", *cols).where(sanitize("id") != "")
        r = r.withColumn("ds", F.concat(F.lit(base), sanitize("id"))).withColumn("label", sanitize("title"))
        self.records = r.withColumn("proc", self.mint(F.concat("ds", F.lit("/publishing-process"))))

    def mint(self, key) -> Column:
        return F.concat(F.lit(self.base), uuid5(key, self.ns))

    def _row(self, df: DataFrame, cls: str, *cols) -> DataFrame:
        return df.select(F.col("iri").alias("ID"), F.lit(cls).alias("TYPE"), *cols)

    def _last(self, df: DataFrame, val: str, *order: str) -> DataFrame:
        return df.groupBy("iri").agg(F.max_by(val, F.struct(*order)).alias(val))

    def _named(self, df: DataFrame, cls: str, val: str = "value") -> DataFrame:
        return self._row(df, cls, F.col(val).alias("label"), F.col(val).alias("value"))

    # --- people ---------------------------------------------------------------------------
    @cached_property
    def people(self) -> DataFrame:
        """(role, name, email, first, last, iri): each mention once, with its first and last place
        in record order. Repeats are folded before anything is minted; nameless people of a
        role share one key."""
        parts = []
        for side, role in enumerate(("contact", "contributor")):
            z = zip_lists(self.records.select("ord", f"{role}_name", f"{role}_email"), {"name": f"{role}_name", "email": f"{role}_email"}, keep_blanks=self.keep_blanks)
            parts.append(z.select(F.struct("ord", F.lit(side).alias("side"), "pos").alias("at"), F.lit(role).alias("role"), "name", "email"))
        out = parts[0].unionByName(parts[1]).groupBy("role", "name", "email").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        return out.withColumn("iri", self.mint(F.concat_ws("|", "name", "role")))

    @cached_property
    def publishers(self) -> DataFrame:
        z = zip_lists(self.records.select("ord", "ds", "label", "proc", "publisher_name", "publisher_email", "publisher_uri"),
                      {"name": "publisher_name", "email": "publisher_email", "uri": "publisher_uri"}, keep_blanks=self.keep_blanks)
        z = z.where("name <> '' or email <> '' or uri <> ''")
        key = F.when(F.col("name") != "", F.col("name")).otherwise(F.col("uri"))
        shown = F.coalesce(F.nullif("name", F.lit("")), F.nullif("email", F.lit("")), key)
        z = z.withColumn("agent_key", key).withColumn("agent", self.mint(key)).withColumn("shown", shown)
        z = z.withColumn("written", F.when(F.col("shown") != "", self.mint(F.concat(F.lit("written-name|"), "shown"))).otherwise(""))
        return z.withColumn("role_iri", self.mint(F.concat("proc", F.lit("/"), "agent")))

    def email_iri(self, c) -> Column:
        return F.when(F.col(c) != "", self.mint(F.lower(F.col(c)))).otherwise("")

    # --- the twelve tables ----------------------------------------------------------------
    def datasets(self) -> DataFrame:
        lic = self._license_key()
        urls = F.array_join(split_list("resource_urls"), ";")
        return self.records.select(
            F.col("ds").alias("ID"), F.lit(self.terms.data_collection).alias("TYPE"), "label",
            F.when(F.col("label") != "", self.mint(F.concat("ds", F.lit("/title")))).otherwise("").alias("denoted_by_title"),
            sanitize("description").alias("description"), F.when(lic != "", self.mint(F.lower(lic))).otherwise("").alias("license"),
            F.col("proc").alias("publishing_process"), urls.alias("has_url"))

    def titles(self) -> DataFrame:
        t = self.records.where("label <> ''").select("ord", self.mint(F.concat("ds", F.lit("/title"))).alias("iri"), F.col("label").alias("value"))
        return self._named(self._last(t, "value", "ord"), self.terms.title)

    def organizations(self) -> DataFrame:
        o = self.records.withColumn("oid", sanitize("organization_id")).where("oid <> ''")
        o = o.select("ord", F.concat(F.lit(self.base), "oid").alias("iri"), F.struct(
            F.coalesce(F.nullif(sanitize("organization_title"), F.lit("")), "oid").alias("label"),
            sanitize("organization_description").alias("description")).alias("v"))
        first = o.groupBy("iri").agg(F.min_by("v", "ord").alias("v"))
        return self._row(first, self.terms.organization, "v.label", "v.description")

    def persons(self) -> DataFrame:
        p = self.people
        key = F.concat_ws("|", "name", "role")
        shown = F.coalesce(F.nullif("name", F.lit("")), F.nullif("email", F.lit("")), key)
        lab = p.groupBy("iri").agg(F.min_by(shown, "first").alias("label"), F.min("name").alias("n"))
        links = p.select("iri", F.explode(F.array(self.email_iri("email"), self._written("name"))).alias("d")).where("d <> ''").distinct()
        # a person's own distinct addresses and names, as one cell
        cell = links.groupBy("iri").agg(F.array_join(F.array_sort(F.collect_list("d")), ";").alias("denoted_by"))
        out = lab.join(cell, "iri", "left").withColumn("denoted_by", F.coalesce("denoted_by", F.lit("")))
        return self._row(out, self.terms.person, "label", "denoted_by", F.when(F.col("n") == "", "nameless").otherwise("").alias("quality"))

    def _written(self, c) -> Column:
        return F.when(F.col(c) != "", self.mint(F.concat(F.lit("written-name|"), F.col(c)))).otherwise("")

    def emails(self) -> DataFrame:
        at = F.struct("ord", F.lit(2).alias("side"), "pos")
        pub = self.publishers.groupBy(F.col("email").alias("value")).agg(F.max(at).alias("last"))
        e = self.people.select(F.col("email").alias("value"), "last").unionByName(pub)
        e = e.where("value <> ''").withColumn("iri", self.mint(F.lower("value")))
        return self._named(self._last(e, "value", "last"), self.terms.email)

    def websites(self) -> DataFrame:
        w = self.publishers.where("uri <> ''").select(self.mint("uri").alias("iri"), F.col("uri").alias("value")).distinct()
        return self._row(w, self.terms.website, F.col("value").alias("label"), F.col("value").alias("url"))

    def written_names(self) -> DataFrame:
        n = self.people.select(F.col("name").alias("value")).unionByName(self.publishers.select(F.col("shown").alias("value")))
        n = n.where("value <> ''").distinct().withColumn("iri", self.mint(F.concat(F.lit("written-name|"), "value")))
        return self._named(n, self.terms.written_name)

    def _license_key(self) -> Column:
        return F.coalesce(F.nullif(sanitize("license_id"), F.lit("")), sanitize("license_title"))

    def licenses(self) -> DataFrame:
        lab = F.coalesce(F.nullif(sanitize("license_title"), F.lit("")), sanitize("license_id"))
        r = self.records.select("ord", self._license_key().alias("k"), lab.alias("value")).where("k <> ''")
        return self._named(self._last(r.withColumn("iri", self.mint(F.lower("k"))), "value", "ord"), BASE + "ont/License")

    def _date_iri(self) -> Column:
        d = date_mdy("metadata_created")
        return F.when(d != "", self.mint(F.concat(F.lit("publishing-date|"), d))).otherwise("")

    def processes(self) -> DataFrame:
        """Participants and roles in order of first appearance, each once."""
        r = self.records.select(F.col("proc").alias("iri"), "ord", F.struct(
            F.concat(F.lit("dataset publishing process for "), F.coalesce(F.nullif("label", F.lit("")), "ds")).alias("label"),
            self._date_iri().alias("d")).alias("v"))
        base = r.groupBy("iri").agg(F.min_by("v", "ord").alias("v"))

        def ordered(c: str, sep: str) -> DataFrame:
            firsts = self.publishers.groupBy(F.col("proc").alias("iri"), F.col(c).alias("m")).agg(F.min(F.struct("ord", "pos")).alias("at"))
            return ordered_members(firsts, "iri", "at", "m", sep, c)

        out = base.join(ordered("agent", "|"), "iri", "left").join(ordered("role_iri", ","), "iri", "left")
        return self._row(out, BASE + "ont/PublishingProcess", F.col("v.label").alias("label"),
                         F.coalesce("agent", F.lit("")).alias("has_participant"), F.coalesce("role_iri", F.lit("")).alias("realizes_role"),
                         F.col("v.d").alias("occupies_temporal_region"), F.lit("").alias("standard"))

    def agents(self) -> DataFrame:
        p = self.publishers.select("ord", "pos", F.col("agent").alias("iri"), F.struct(
            F.concat(F.lit("ContactPoint: "), "shown").alias("label"), F.col("written").alias("w")).alias("v"))
        first = p.groupBy("iri").agg(F.min_by("v", F.struct("ord", "pos")).alias("v"))
        return self._row(first, BASE + "ont/ContactPoint", F.col("v.label").alias("label"), F.col("v.w").alias("denoted_by_written_name"))

    def roles(self) -> DataFrame:
        p = self.publishers.select("ord", "pos", F.col("role_iri").alias("iri"), F.struct(
            F.concat(F.lit("ContactPointRole for "), F.coalesce(F.nullif("label", F.lit("")), "ds")).alias("label"),
            self.email_iri("email").alias("role_email"), F.when(F.col("uri") != "", self.mint("uri")).otherwise("").alias("role_website"),
            F.col("written").alias("written_name"), F.col("agent").alias("role_of")).alias("v"))
        return self._row(self._last(p, "v", "ord", "pos"), BASE + "ont/ContactPointRole", "v.*")

    def dates(self) -> DataFrame:
        d = self.records.select(date_mdy("metadata_created").alias("value")).where("value <> ''").distinct()
        d = d.withColumn("iri", self.mint(F.concat(F.lit("publishing-date|"), "value")))
        return self._row(d, BASE + "ont/TemporalRegion", F.lit("DatasetPublishingDate").alias("label"), "value")

    TABLES = ["datasets", "titles", "organizations", "persons", "emails", "websites", "written_names", "licenses",
              "processes", "agents", "roles", "dates"]

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t)() for t in self.TABLES}


def ordered_members(df: DataFrame, by: str, order: str, member: str, sep: str, name: str) -> DataFrame:
    """Distinct members of a group in order, as one delimited cell (a cell is what is asked for)."""
    first = df.groupBy(by, member).agg(F.min(order).alias("__o"))
    items = F.array_sort(F.collect_list(F.struct("__o", member)))
    return first.groupBy(by).agg(F.array_join(F.transform(items, lambda x: x[member]), sep).alias(name))


def flatten_nested(records: DataFrame) -> DataFrame:
    """Nested portal records to the flat columns: names and e-mails joined with '; '."""
    def joined(arr: str, fld: str) -> Column:
        return F.coalesce(F.array_join(F.transform(F.col(arr), lambda x: F.coalesce(x[fld], F.lit(""))), "; "), F.lit(""))

    return records.select(
        "id", "title", F.col("notes").alias("description"), "license_id", "metadata_created", "metadata_modified", "type",
        joined("contact", "name").alias("contact_name"), joined("contact", "email").alias("contact_email"),
        joined("contributor", "name").alias("contributor_name"), joined("contributor", "email").alias("contributor_email"),
        joined("publisher", "name").alias("publisher_name"), joined("publisher", "email").alias("publisher_email"),
        joined("publisher", "uri").alias("publisher_uri"), F.col("organization.id").alias("organization_id"),
        F.col("organization.title").alias("organization_title"), F.col("organization.description").alias("organization_description"),
        joined("tags", "name").alias("tags"), F.coalesce(F.size("resources"), F.lit(0)).alias("num_resources"),
        joined("resources", "format").alias("resource_formats"), joined("resources", "url").alias("resource_urls"))
