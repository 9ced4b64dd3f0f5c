"""Moving averages over a given series window."""

from pyspark.sql import functions as F

TRAILING_ROWS = 42
TRAILING_MIN = 30


def centre_reach(width):
    """(rows before, rows after) of a centred frame; even widths lean backwards."""
    after = (width - 1) // 2
    return width - 1 - after, after


def _mean_with_count(column, frame, least):
    return F.when(F.count(column).over(frame) >= least, F.avg(column).over(frame))


def trailing_mean(df, column, window, out, width=TRAILING_ROWS, least=TRAILING_MIN):
    return df.withColumn(out, _mean_with_count(column, window.rowsBetween(-(width - 1), 0), least))


def centred_mean(df, column, window, out, width=24, least=None):
    """``least`` defaults to a full frame."""
    before, after = centre_reach(width)
    return df.withColumn(out, _mean_with_count(column, window.rowsBetween(-before, after), least or width))
