"""Match the rows of two catalogues with Spark.

A *query* side and a *database* side are cleaned, turned into unit vectors and
joined: for every query row, inside its category, the k database rows with the
highest inner product.  Everything is a lazy DataFrame plan; see ``plans`` for
the end-to-end jobs and ``operators`` for the parts they are made of.
"""

from importlib import import_module

_PUBLIC = {
    "MatchConfig": "twinshelf.config",
    "export_review": "twinshelf.plans.export",
    "match": "twinshelf.plans.match",
    "prepare_image_side": "twinshelf.plans.prepare",
    "prepare_text_side": "twinshelf.plans.prepare",
    "rerank": "twinshelf.plans.rerank",
    "run_match": "twinshelf.plans.match",
    "run_rerank": "twinshelf.plans.rerank",
    "save_csv": "twinshelf.plans.export",
}
__all__ = sorted(_PUBLIC)


def __getattr__(name: str):
    # resolved on use: tasks import this package too, and need none of the plans
    if name not in _PUBLIC:
        raise AttributeError(name)
    return getattr(import_module(_PUBLIC[name]), name)
