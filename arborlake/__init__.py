"""arborlake: connectomics analytics on Spark DataFrames."""
