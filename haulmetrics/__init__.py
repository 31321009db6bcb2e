"""Supply-chain analytics on Spark: order-line preparation, KPIs, shipping cost,
delivery-time and late-risk models, warehouse placement and delivery routes.

Every operator takes and returns DataFrames.
"""
