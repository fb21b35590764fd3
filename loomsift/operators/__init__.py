"""loomsift.operators"""
