"""tagloom: restriction-tag sequencing analytics as Spark DataFrame plans."""
