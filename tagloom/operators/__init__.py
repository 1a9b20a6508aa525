"""tagloom.operators"""
