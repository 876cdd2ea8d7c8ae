"""ledgerlens.operators"""
