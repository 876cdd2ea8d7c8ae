"""ledgerlens.sources"""
