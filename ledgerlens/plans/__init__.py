"""ledgerlens.plans"""
