"""loomsift.plans"""
