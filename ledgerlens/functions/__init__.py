"""ledgerlens.functions"""
