"""Match a query side against a database side by text or by image."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.config import DATABASE, QUERY, MatchConfig, require_columns
from twinshelf.operators.ann import build_cells, knn_cells, knn_planes
from twinshelf.operators.cell_tree import build_tree, knn_tree
from twinshelf.operators.encode import embed, embed_once, get_encoder
from twinshelf.operators.knn import knn_join, knn_join_values, with_payload
from twinshelf.operators.rows import guard_groups
from twinshelf.plans.ledger import Ledger, config_key
from twinshelf.plans.resume import pending_categories
from twinshelf.session import cut, scratch_path
from twinshelf.sources.images import read_images
from twinshelf.sources.tables import write_by_category


def with_vectors(
    side: DataFrame, mode: str, config: MatchConfig, images: DataFrame | None = None,
    vector_table: str | None = None,
) -> DataFrame:
    """The side with its unit-vector column; a side that has one is kept as it is."""
    if config.vector_col in side.columns:
        return side
    source = config.side(mode, config.input_col)
    require_columns(side, [source], f"{mode} side")
    if config.match_by == "image":
        if images is None:
            raise ValueError("matching by image needs the decoded images")
        return side.join(image_vectors(side, source, config, images, vector_table), source, "left")
    if vector_table is None:
        side = embed(side, source, config.vector_col, config.encoder_name)
    else:
        side = embed_once(
            side, vector_table, key=config.side(mode, config.id_col), input_col=source,
            out_col=config.vector_col, encoder=config.encoder_name,
        )
    return side


def image_vectors(
    side: DataFrame, source: str, config: MatchConfig, images: DataFrame, vector_table: str | None
) -> DataFrame:
    """Path and vector of the side's images, embedded where they are read.

    Only paths and vectors are shuffled; an image that is missing or cannot be decoded
    leaves its row without a vector.
    """
    paths = side.select(source).where(F.col(source).isNotNull()).distinct()
    named = images.withColumnRenamed("file_path", source)
    if vector_table is None:
        made = named
        if config.vector_col not in images.columns:
            made = embed(named, "image", config.vector_col, config.encoder_name)
        return made.select(source, config.vector_col).join(paths, source, "left_semi")
    wanted = named.join(paths, source, "left_semi")
    made = embed_once(
        wanted, vector_table, key=source, input_col="image", out_col=config.vector_col,
        encoder=config.encoder_name,
    )
    return made.select(source, config.vector_col)


def join_settings(config: MatchConfig) -> dict:
    """What all joins take from the configuration."""
    return dict(
        k=config.top_k,
        q_id=config.side(QUERY, config.id_col),
        db_id=config.side(DATABASE, config.id_col),
        by=[(config.side(QUERY, config.category), config.side(DATABASE, config.category),
             "category")],
        min_group_size=config.min_group_size,
        block_rows=config.block_rows,
        exclude_self=config.exclude_self,
        score=config.score_col,
    )


def nearest(q: DataFrame, db: DataFrame, config: MatchConfig) -> DataFrame:
    """Hits by the configured method: category, both ids, score and rank."""
    common = dict(join_settings(config), q_vec=config.vector_col, db_vec=config.vector_col)
    if config.method != "exact":
        # these look at the vectors several times: the encoder must not run as often
        q, db = cut(q), cut(db)
    if config.method in ("cells", "bounded"):
        path = config.index_path or scratch_path(db.sparkSession, "cells")
        index = build_cells(db, path, vec=config.vector_col, n_cells=config.n_cells)
        return knn_cells(q, index, nprobe=config.nprobe, exact=config.method == "bounded",
                         target_recall=config.target_recall, **common)
    if config.method == "tree":
        tree = build_tree(db, config.index_path or scratch_path(db.sparkSession, "tree"), vec=config.vector_col,
                          n_cells=config.n_cells)
        return knn_tree(q, tree, beam=config.beam, nprobe=config.nprobe, target_recall=config.target_recall, **common)
    if config.method == "planes":
        return knn_planes(q, db, width=config.vector_width, tables=config.plane_tables,
                          bits=config.plane_bits, probes=config.plane_probes,
                          target_recall=config.target_recall, **common)
    return knn_join(q, db, **common)


def match(
    q: DataFrame,
    db: DataFrame,
    config: MatchConfig = MatchConfig(),
    *,
    images: DataFrame | None = None,
    vector_tables: tuple[str, str] | None = None,
) -> DataFrame:
    """Flat hits: category, every column of both sides, score and rank.

    All categories are one plan.  Only ids, vectors and the category enter the
    join; the other columns are attached to the k hits afterwards.
    """
    q_id, db_id = config.side(QUERY, config.id_col), config.side(DATABASE, config.id_col)
    q_cat, db_cat = config.side(QUERY, config.category), config.side(DATABASE, config.category)
    require_columns(q, [q_id, q_cat], "query side")
    require_columns(db, [db_id, db_cat], "database side")
    q_table, db_table = vector_tables or (None, None)
    made_here = config.vector_col not in q.columns and config.vector_col not in db.columns
    if config.method == "exact" and config.match_by == "text" and made_here and not (q_table or db_table):
        texts = [config.side(mode, config.input_col) for mode in (QUERY, DATABASE)]
        for df, text, mode in zip((q, db), texts, (QUERY, DATABASE)):
            require_columns(df, [text], f"{mode} side")
        hits = knn_join_values(
            q.select(q_id, q_cat, texts[0]), db.select(db_id, db_cat, texts[1]), q_value=texts[0], db_value=texts[1],
            vectors=get_encoder(config.encoder_name), **join_settings(config),
        )
    else:
        if config.match_by == "image" and images is not None and made_here and not (q_table or db_table):
            # both sides take their vectors from one reading of the files
            made = embed(images, "image", config.vector_col, config.encoder_name)
            images = cut(made.select("file_path", config.vector_col).hint("rebalance"))
        hits = nearest(
            with_vectors(q, QUERY, config, images, q_table).select(q_id, q_cat, config.vector_col),
            with_vectors(db, DATABASE, config, images, db_table).select(
                db_id, db_cat, config.vector_col
            ),
            config,
        )
    q_cols = [c for c in q.columns if c != config.vector_col]
    db_cols = [c for c in db.columns if c != config.vector_col]
    hits = with_payload(hits, q, {q_id: q_id, "category": q_cat}, q_cols)
    hits = with_payload(hits, db, {db_id: db_id, "category": db_cat}, db_cols)
    return hits.select("category", *q_cols, *db_cols, config.score_col, "rank")


def run_match(
    spark: SparkSession,
    path_q: str,
    path_db: str,
    out: str,
    config: MatchConfig = MatchConfig(),
    *,
    image_folder: str | None = None,
    vector_tables: tuple[str, str] | None = None,
    resume: str = "category",
) -> dict[str, float]:
    """Read both sides, match, and write one partition per category.

    ``resume="category"`` skips categories that already have a result; ``resume="query"`` skips
    query rows that a run with the same settings has matched, whether they have hits or
    not, and adds the hits of the others; read them with :func:`read_matched`.
    Returns the elapsed seconds.
    """
    start = time.perf_counter()
    q, db = spark.read.parquet(path_q), spark.read.parquet(path_db)
    q_cat, db_cat = config.side(QUERY, config.category), config.side(DATABASE, config.category)
    images = read_images(spark, image_folder) if image_folder else None
    if resume not in ("category", "query"):
        raise ValueError(f"resume must be 'category' or 'query', not {resume!r}")
    if resume == "category":
        hits = match(pending_categories(q, q_cat, out), db, config, images=images, vector_tables=vector_tables)
        write_by_category(hits, out)
    else:
        key = config_key(config, path_db)
        # whether a category is large enough must not depend on what is left of it
        q, db = guard_groups(q, db, [(q_cat, db_cat, "category")], config.min_group_size)
        config = replace(config, min_group_size=1)
        Ledger(spark, out).run(
            q, key, config.side(QUERY, config.id_col), q_cat,
            lambda left: match(left, db, config, images=images, vector_tables=vector_tables), write_by_category,
        )
    return {f"time_perf_{config.match_by}": time.perf_counter() - start}
