"""Document quality: hashed word n-gram logistic regression with FTRL updates.

Values are counts on a unit length, so a score speaks for the whole text whatever its
length; it is a sparse dot product with the non-zero weights.
"""

from . import linear

THRESHOLD = 0.3
FEATURES = {"bits": 20, "skips": (), "counts": True}
LEARNING = {"alpha": 0.5, "beta": 1.0, "l1": 0.05, "l2": 1e-4, "epochs": 3}


def score_quality(docs, labels):
    """doc_id, held_out, score (0 to 1, higher is better) and predicted (score >= 0.3).

    Null and empty texts get the score of a text without features. Without labels of both
    kinds everything scores 1. Null doc_id: scored, never held out. Repeated rows are scored
    alike; an empty table gives no rows; other columns are not read.
    """
    model = linear.fit(docs, labels, "quality", **FEATURES, **LEARNING)
    return linear.scored(docs, linear.scorer(model, **FEATURES, empty_model=1.0), THRESHOLD)
