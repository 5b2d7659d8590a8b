"""Analytics for sparse surfaces on fixed longitude/latitude grids, on DataFrames."""
