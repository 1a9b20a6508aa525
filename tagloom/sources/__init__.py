"""tagloom.sources"""
