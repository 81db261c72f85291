from shelfspark.functions.bins import lower_edges, lower_bins, upper_bins, upper_edges
from shelfspark.functions.scalar import (
    band_columns,
    binarize,
    bucket_index,
    double,
    nan_to_null,
    oos_exact,
    oos_nonpositive,
    parse_iso_date,
    percent,
    ratio,
    round_n,
)
