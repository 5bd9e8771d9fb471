"""DataFrame -> DataFrame steps the feature plans are made of."""
