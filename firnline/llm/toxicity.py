"""Toxic documents: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A feature is present or not, so one slur in a long text counts as much as in a short one; the
L1 term leaves weights only where the labels speak for them.
"""

from . import linear

THRESHOLD = 0.5
FEATURES = {"bits": 20, "skips": (1, 2), "counts": False}
LEARNING = {"alpha": 1.0, "beta": 1.0, "l1": 10.0, "l2": 1e-4, "positive": 4.0, "epochs": 3}


def score_toxicity(docs, labels):
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of every row of ``docs``.

    Null and empty texts get the score of a text without features. Without labels of both
    kinds nothing is called toxic (score 0). Null doc_id: scored, never held out. Repeated rows are
    scored alike; an empty table gives no rows; other columns are not read.
    """
    return linear.scored(docs, linear.scorer(linear.fit(docs, labels, "toxic", **FEATURES, **LEARNING), **FEATURES), THRESHOLD)


def drop_toxic(docs, labels):
    """``docs`` without the rows that the classifier calls toxic; columns as they are."""
    score = linear.scorer(linear.fit(docs, labels, "toxic", **FEATURES, **LEARNING), **FEATURES)
    return docs.where(score(docs["text"]) < THRESHOLD)
