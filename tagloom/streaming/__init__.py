"""tagloom.streaming"""
