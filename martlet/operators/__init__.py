"""DataFrame -> DataFrame builders: reporting marts, dashboards, dimensions,
feed unification, the change window and the merge upsert."""
