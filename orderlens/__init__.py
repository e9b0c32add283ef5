"""Order, stock and shipment analytics on Spark DataFrames."""
