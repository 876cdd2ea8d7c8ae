"""ledgerlens.streaming"""
