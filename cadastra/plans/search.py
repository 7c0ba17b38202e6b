"""Questions asked of the company documents. Searches return whole documents, as a set of the three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.cleansing import strip
from cadastra.operators.keyset import maybe_among
from cadastra.operators.ranking import by_total, small
from cadastra.operators.skew import dealt, hot_keys, salted_join, tasks_for
from cadastra.plans.documents import Documents

FOUND, ABSENT, INVALID = "encontrado", "ausente", "invalido"


def by_company(documents: Documents, company: int) -> Documents:
    return documents.each(lambda table: table.where(F.col("_id") == company))


def _asked_ids(requests: DataFrame, id_text: str) -> DataFrame:
    return requests.withColumn("_id", strip(F.col(id_text)).try_cast("bigint"))


def look_up(requests: DataFrame, id_text: str, documents: Documents, hot: dict | None = None) -> DataFrame:
    """Bulk lookup: every request row with a status and, if found, the company header.

    Requests that are no number are kept and marked. ``hot`` lists ids asked for very often. The lists
    stay out of this join, where they would be repeated per request; see ``requested_documents``.
    """
    known = documents.headers.drop("bucket").withColumn("_known", F.lit(True))
    found = salted_join(_asked_ids(requests, id_text), known, "_id", "left", hot)
    status = F.when(F.col("_id").isNull(), INVALID).when(F.col("_known"), FOUND).otherwise(ABSENT)
    return found.withColumn("status", status).drop("_known")


def look_up_stored(
    requests: DataFrame, id_text: str, documents: Documents, buckets: int, hot: dict | None = None
) -> DataFrame:
    """``look_up`` in stored documents of so many buckets.

    The ids asked for carry their bucket. Where they are few enough to be broadcast, they prune the buckets at run time,
    so only those asked for are read.
    """
    asked = _asked_ids(requests, id_text).select("_id").where("_id IS NOT NULL").distinct()
    placed = asked.withColumn("bucket", F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int"))
    # Spark prunes by a side only if it has a condition; a bucket that is none cannot be asked for
    held = documents.headers.join(placed.where("bucket >= 0"), ["bucket", "_id"], "left_semi")
    return look_up(requests, id_text, documents._replace(headers=held), hot)


def requested_documents(requests: DataFrame, id_text: str, documents: Documents) -> Documents:
    """The whole documents that were asked for, each once however often it was.

    Others go by the flags of the ids asked for, which Spark meets below the aggregations the documents are made by."""
    asked = _asked_ids(requests, id_text).select("_id").distinct()
    return documents.each(lambda table: maybe_among(table, asked, "_id")).of(asked)


def by_state_and_activity(
    documents: Documents,
    state: str,
    activity: int | None = None,
    limit: int | None = 50,
    same_unit: bool = False,
) -> Documents:
    """Companies with an establishment in the state and one of the activity.

    The two may be different establishments unless ``same_unit`` is set. The answer is the first
    ``limit`` companies by id.
    """
    in_state = F.col("unidade.endereco.uf") == F.upper(F.lit(state))
    in_activity = F.col("unidade.cnae_fiscal_principal") == F.lit(activity)

    def having(test: Column) -> DataFrame:
        return documents.units.where(test).select("_id").distinct()

    if activity is None:
        wanted = having(in_state)
    elif same_unit:
        wanted = having(in_state & in_activity)
    else:
        # two filters that reach the files, rather than flags over all establishments
        wanted = having(in_state).join(having(in_activity), "_id", "left_semi")
    if limit is not None:
        wanted = small(wanted.orderBy("_id").limit(limit), limit)
    return documents.of(wanted)


def by_secondary_activity(documents: Documents, activity: int) -> Documents:
    held = F.array_contains("unidade.cnae_fiscal_secundarias", F.lit(activity))
    return documents.of(documents.units.where(held).select("_id").distinct())


def _number(alias: str) -> Column:
    return F.sum("copies").alias(alias)


def count_by_state(documents: Documents) -> DataFrame:
    """Establishments per state, over all documents."""
    counts = documents.units.groupBy(F.col("unidade.endereco.uf").alias("uf")).agg(_number("total"))
    return by_total(counts, "uf")


def branches_by_state(documents: Documents, company: int | None = None) -> DataFrame:
    """Establishments per company and state; of one company, the most common state first, if given."""
    chosen = documents if company is None else by_company(documents, company)
    keys = ["_id", F.col("unidade.endereco.uf").alias("uf")]
    counts = chosen.units.groupBy(*keys).agg(_number("filiais"))
    return counts if company is None else by_total(counts, "uf", "filiais")


def name_search(documents: Documents, text: str) -> DataFrame:
    """Establishments whose company or trade name contains the text, in any case."""
    wanted = F.upper(F.lit(text))
    rows = documents.units.join(documents.headers.select("_id", "razao_social"), "_id").where(
        F.contains(F.upper("razao_social"), wanted) | F.contains(F.upper("unidade.nome_fantasia"), wanted)
    )
    return rows.select(
        "_id",
        "razao_social",
        F.col("unidade.cnpj_ordem").alias("cnpj_ordem"),
        F.col("unidade.cnpj_dv").alias("cnpj_dv"),
        F.col("unidade.nome_fantasia").alias("nome_fantasia"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


# Postings of names: every piece of up to three characters of a company's names, in upper case, with its company. A piece of
# fewer characters stands at the end of its name, so a prefix of pieces finds any text of one or two characters.

PIECE = 3


def _pieces(name: Column) -> Column:
    places = F.when(F.length(name) > 0, F.sequence(F.lit(1), F.length(name)))
    return F.transform(places, lambda at: F.substring(name, at, F.lit(PIECE)))


def name_postings(documents: Documents, known: DataFrame | None = None) -> DataFrame:
    """(gram, _id), once per company and piece; those of the documents and those ``known``."""
    company = documents.headers.select("_id", F.upper("razao_social").alias("name"))
    trade = documents.units.select("_id", F.upper("unidade.nome_fantasia").alias("name"))
    names = company.unionAll(trade)
    # Names of a company share most of their pieces, which are many times as many as the names: where its names meet in one task, the
    # pieces do too, and are not shuffled. Not so if a company has too many for a task.
    together = not hot_keys(trade, "_id")
    if together:
        names = _by_company(names, documents)
    # a name that many establishments of a company bear is cut once
    pieces = names.distinct().select("_id", F.explode(_pieces(F.col("name"))).alias("gram"))
    if together and known is not None:
        known = _by_company(known.select(*pieces.columns), documents)
    return _with(pieces, known).distinct().select("gram", "_id")


def _by_company(rows: DataFrame, documents: Documents) -> DataFrame:
    tasks = tasks_for(rows.sparkSession, documents.units.count())
    return rows.repartition(*[tasks] if tasks else [], "_id")


def _with(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    return rows if known is None else rows.unionByName(known.select(*rows.columns))


def name_search_indexed(documents: Documents, postings: DataFrame, text: str) -> DataFrame:
    """``name_search`` of the companies whose names hold all pieces of the text; other companies stay unread.

    An empty text is in every name, so all are scanned."""
    if not text:
        return name_search(documents, text)
    # a constant, so no job runs for it; the same upper case as that of the names
    wanted = postings.sparkSession.sql("SELECT upper(:text)", {"text": text}).first()[0]
    keys = [c for c in ("bucket", "_id") if c in postings.columns and c in documents.units.columns]
    if len(wanted) < PIECE:
        found = postings.where(F.startswith("gram", F.lit(wanted))).select(*keys).distinct()
    else:
        pieces = sorted({wanted[at : at + PIECE] for at in range(len(wanted) - PIECE + 1)})
        held = postings.where(F.col("gram").isin(pieces)).groupBy(*keys).agg(F.count("*").alias("pieces"))
        found = held.where(F.col("pieces") == len(pieces)).select(*keys)
    return name_search(documents.of(found, keys), text)


def collection_stats(documents: Documents, name: str = "documentos", database: str = "cadastro") -> DataFrame:
    return documents.headers.agg(F.count("*").alias("total_documentos")).select(
        "total_documentos", F.lit(name).alias("nome"), F.lit(database).alias("banco")
    )


# Side table for activity searches, laid out by state and activity.


def activity_index(documents: Documents, known: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """(uf, cnae, principal, _id), once per company, state and activity; with ``bucket`` for stored documents. Rows that are ``known``
    already are among them."""
    unit = F.col("unidade")
    main = F.struct(unit["cnae_fiscal_principal"].alias("cnae"), F.lit(True).alias("principal"))
    others = F.transform(
        unit["cnae_fiscal_secundarias"], lambda c: F.struct(c.alias("cnae"), F.lit(False).alias("principal"))
    )
    place = [c for c in ("bucket",) if c in documents.units.columns]
    rows = documents.units.select(
        unit["endereco"]["uf"].alias("uf"), "_id", *place, F.inline(F.concat(F.array(main), others))
    )
    rows = _with(rows.select("uf", "cnae", "principal", "_id", *place), known)
    return dealt(rows, tasks, "_id", "cnae").distinct()


def activity_postings(documents: Documents, known: DataFrame | None = None) -> DataFrame:
    """The same rows for a store, which places them itself."""
    tasks = tasks_for(documents.units.sparkSession, documents.units.count())
    return activity_index(documents.each(lambda table: table.drop("bucket")), known, tasks)


def write_activity_index(documents: Documents, path: str) -> None:
    """Range layout by state, activity and company: a common activity is cut at company ids."""
    ordered = activity_index(documents).repartitionByRange("uf", "cnae", "_id").sortWithinPartitions("cnae", "_id")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("uf").parquet(path)


def by_index(documents: Documents, index: DataFrame, activity: int, state: str | None = None) -> Documents:
    """The whole documents the index names; stored ones are joined on bucket and id, so other buckets stay unread."""
    hits = index.where(F.col("cnae") == activity)
    if state is not None:
        hits = hits.where(F.col("uf") == state.upper())
    keys = [c for c in ("bucket", "_id") if c in hits.columns and c in documents.units.columns]
    return documents.of(hits.select(*keys).distinct(), keys)
