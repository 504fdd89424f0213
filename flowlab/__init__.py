"""flowlab: lazy, column-parameterised Spark operators for labelled event and network-flow data."""
