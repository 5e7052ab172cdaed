"""spotweave: spatial-transcriptomics analytics as composable Spark DataFrame operators."""
