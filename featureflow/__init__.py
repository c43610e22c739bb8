"""featureflow: from raw files to scored predictions, as Spark plans."""
